"""Ids of a word-level BPE tokenizer file, one white-space chunk at a time.

The tokenizer lower-cases, drops white space and never joins pieces across it,
so the ids of a text are the ids of its chunks between spaces and newlines, in
order (other white space inside a chunk is left to the library).  A chunk's
ids are kept in a bounded cache.  A chunk of plain Latin characters is cut
into pre-tokens here and each new pre-token goes to the library's BPE model
once; every other chunk goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from daybook.llm.common import CACHES

#: The file's pre-token pattern, for characters below U+0250 only.
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: ASCII, the Latin-1 letters and Latin Extended-A: letters, digits and marks
#: on which Python's and the library's character classes and lower-casing agree.
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ňŊ-ž]+")
MAX_CHUNKS = 300_000
MAX_PIECES = 1_000_000


def _byte_characters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder over one tokenizer file (``word_bpe_49k.json`` or alike)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec["model"].get("type") != "BPE" or not spec["model"].get("end_of_word_suffix")
                or "Lowercase" not in json.dumps(spec["normalizer"])):
            raise ValueError(f"{path}: not a lower-casing word-level BPE file")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.model = self.tokenizer.model
        self.table = _byte_characters()
        self.chunks: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.by_id: list[str] | None = None

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
            if len(self.pieces) >= MAX_PIECES:
                self.pieces.clear()
            ids = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
        return ids

    def encode_chunk(self, chunk: str) -> bytes:
        """Little-endian 32-bit ids of one chunk, uncached."""
        if PLAIN.fullmatch(chunk) and not any(s in chunk for s in self.special):
            return b"".join(map(self._piece, LATIN_PIECES.findall(chunk.lower())))
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def pieces_by_id(self) -> list[str]:
        """Every id's piece; only for a file without a decoder, where the library
        joins the pieces of a text with spaces."""
        if self.tokenizer.decoder is not None:
            raise ValueError("the file has a decoder of its own")
        if self.by_id is None:
            n = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
            self.by_id = [self.tokenizer.id_to_token(i) or "" for i in range(n)]
        return self.by_id

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a whole text."""
        chunks = text.replace("\n", " ").split(" ")
        found = list(map(self.chunks.get, chunks))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    ids = self.chunks.get(chunks[i])
                    if ids is None:
                        ids = self.encode_chunk(chunks[i])
                        if len(self.chunks) >= MAX_CHUNKS:
                            self.chunks = {"": b""}
                        self.chunks[chunks[i]] = ids
                    found[i] = ids
        return b"".join(found)


_ENCODERS: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The process's encoder for ``path`` (Python workers are reused across tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordBpe(path)
    return _ENCODERS[path]


CACHES.append(_ENCODERS.clear)
