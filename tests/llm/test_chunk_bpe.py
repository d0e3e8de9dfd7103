"""Chunk-wise BPE against the library on whole texts."""

import random

import numpy as np
import pytest

from daybook.llm import chunk_bpe
from daybook.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF_SMALL

PASSAGE = " ".join(f"word{i % 37} it's {i}, naïve Ünder <|endoftext|>tail" for i in range(60))


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def check(df, texts, tok):
    """Every row's ids and decoded text equal the library's on the whole text."""
    got = sorted(((r["doc_id"], r["ids"], r["n_tokens"], r["decoded"]) for r in df.collect()),
                 key=lambda r: (r[0] is not None, r[0] or 0, bytes(r[1])))
    want = []
    for i, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        want.append((i, np.array(ids, "<u4").tobytes(), len(ids), tok.decode(ids, skip_special_tokens=False)))
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [tuple(g) for g in got] == want


def test_cuts_follow_the_content():
    rng = random.Random(5)
    body = " ".join(rng.choice(["stone", "river", "été", "日本", "x1"]) + str(rng.randrange(99)) for _ in range(4000)).encode()
    ends = chunk_bpe.cuts(body)
    chunks = [body[a:b] for a, b in zip([0, *ends], ends)]
    assert b"".join(chunks) == body and all(chunks)
    for c in chunks:
        c.decode()
    assert all(len(c) >= chunk_bpe.LEAST for c in chunks[:-1]) and max(map(len, chunks)) <= chunk_bpe.MOST + 3
    moved = b"another start of the text, " * 9 + body
    again = chunk_bpe.cuts(moved)
    shared = {moved[a:b] for a, b in zip([0, *again], again)} & set(chunks)
    assert len(shared) > 0.9 * len(chunks)
    assert chunk_bpe.cuts(b"") == [] and chunk_bpe.cuts(b"ab") == [2]
    assert chunk_bpe.cuts(b"a" * 10_000)[-1] == 10_000


def test_shared_chunks_and_joins(spark, tok):
    """Copies, shifted passages, passages cut inside words, special strings, long and odd texts."""
    rng = random.Random(3)
    texts = [(i, PASSAGE) for i in range(90)]                                  # hot chunks
    texts += [(100 + i, "x" * i + PASSAGE[rng.randrange(50):] + "y" * i) for i in range(30)]
    own = " ".join(str(rng.random()) for _ in range(600))
    texts += [(200 + i, own[i:] + "\n" + PASSAGE[:i * 20]) for i in range(5)]   # chunks of the lexicon
    texts += [(300, None), (301, ""), (302, " \n \t"), (302, " \n \t"), (None, "no id"), (None, own),
              (303, "z" * 30_000), (304, "é" * 9_000), (305, PASSAGE * 40), (306, "a\x0bb ć ́d " * 300),
              (307, "<|startoftext|>" * 200), (308, "あ" * 5000 + " " + own)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts],
                                 "doc_id bigint, text string, ids string, `key` int").repartition(5)
    check(chunk_bpe.encode_decode(docs, tokenizer_path()), texts, tok)
    # a bitmap so small that every chunk seems shared gives the same
    check(chunk_bpe.encode_decode(docs, tokenizer_path(), bits=chunk_bpe.ROW_BITS), texts, tok)


def test_every_distinct_chunk_is_encoded_once(spark):
    """The lexicon holds each shared chunk once, and no text encodes its inside again."""
    own = " ".join(str(i * i) for i in range(2000)).encode()
    chunks = [own[a:b] for a, b in zip([0, *chunk_bpe.cuts(own)], chunk_bpe.cuts(own))]
    keys = [chunk_bpe._number(chunk_bpe._hash(c)) for c in chunks]
    rows: dict[int, bytearray] = {}
    for k in keys:
        at = k % chunk_bpe.BITS
        row = rows.setdefault(at // chunk_bpe.ROW_BITS, bytearray(4096))
        row[at % chunk_bpe.ROW_BITS >> 3] |= 1 << (at & 7)
    cutter = chunk_bpe._Cutter(tokenizer_path(), chunk_bpe._Shared(
        {a: bytes(r) for a, r in rows.items()}, set(), chunk_bpe.BITS))
    found = cutter.segments(own, cutter.references(own))
    assert [k for k, _ in found if k] == [chunk_bpe._hash(c) for c in chunks]
    assert sum(len(x) for k, x in found if k) > 0.9 * len(own)


def test_border_that_disagrees_is_given_up(tok):
    """Where words together don't give their own ids, the chunk is not used."""
    cutter = chunk_bpe._Cutter(tokenizer_path(), chunk_bpe._Shared({}, set(), chunk_bpe.BITS))
    data = b"some words in a row"
    assert cutter.agrees(data, 4)

    class Joining:
        def encode(self, text, add_special_tokens):
            return tok.encode(text.replace(" ", ""), add_special_tokens=add_special_tokens)

    class Bpe:
        tokenizer, encode = Joining(), cutter.bpe.encode
    cutter.bpe = Bpe()
    assert not cutter.agrees(data, 4)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    df = chunk_bpe.encode_decode(docs, tokenizer_path())
    assert df.columns == ["doc_id", "ids", "n_tokens", "decoded"] and df.collect() == []


def test_query(spark, tok):
    import hashlib
    rows = QUERIES["op13_bpe_codec"](spark, SF_SMALL).collect()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
