"""BPE encoding and decoding with content-defined chunks that are encoded once.

1. Every text is cut into chunks where a rolling hash over 16 bytes says so, so
   equal passages give equal chunks wherever they stand.  The keys of all
   chunks are counted (64-bit hashes, summed in the task before the shuffle).
2. Chunks seen twice or more are *shared*.  Their hashes go into a bitmap of a
   fixed number of bits, built by Spark's bitmap aggregates; a chance hit only
   sends a chunk the longer way.  Chunks that hold more than a fixed share of
   all places (at most ``HOT_PARTS`` of them, so a bounded list) are *hot*.
3. A text without shared chunks is encoded where it stands; a hot chunk is
   encoded once in each task.  Each other distinct shared chunk goes to the
   tokenizer once in all, and its ids are joined back to the texts.
4. Joins: of a shared chunk only the inside between its first and last
   separator counts.  The text between two insides (the end of one chunk, all
   unshared chunks after it, the start of the next) is encoded anew.  At each
   border the words on both sides are given to the library together; where
   the result isn't the two words' ids in a row, the chunk is given up for
   this text and encoded with its surroundings, until all borders agree.

Decoding joins the pieces of the ids as the library does for a file without a
decoder.

Null texts count as empty and have no ids.  Every row of ``docs`` gives one
row, repeated or null ids included; other columns are ignored, whatever their
names.  An empty table gives an empty result.  A text without separators is
encoded whole, however long.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import handoff, slices

AVERAGE = 512                 # bytes between cuts, a power of two
LEAST, MOST = 128, 4096       # bytes of a chunk
#: Bits of the bitmap of shared chunks (16 MB), and bits of one row of it.
BITS, ROW_BITS = 1 << 27, 32768
#: A chunk with more than 1 / HOT_PARTS of all places (and 64 at least) is hot.
HOT_PARTS, HOT_LEAST = 4096, 64
FLUSH = 400_000

#: Rows whose ids and decoded texts are held at a time.
SLICE = 64
SEPARATOR = re.compile(rb"[ \n]")
INSIDE = pa.struct([("key", pa.binary()), ("inside", pa.binary())])


def _gear() -> np.ndarray:
    """One 32-bit number a byte value, by a fixed multiplicative rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def cuts(data: bytes, average: int = AVERAGE, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of ``data`` (UTF-8), the last one being its length.

    A cut depends on the 16 bytes before it and on the cut before, not on the
    place in the text, and never falls inside a character.
    """
    n = len(data)
    if n <= least:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h = GEAR[raw]
    for step in (1, 2, 4, 8):             # the sum of 16 shifted numbers, by doubling
        shifted = h.copy()
        shifted[step:] += h[:-step] << np.uint32(step)
        h = shifted
    ends, last = [], 0

    def cut(at: int) -> int:
        while at < n and raw[at] & 0xC0 == 0x80:
            at += 1
        if at < n:
            ends.append(at)
        return at
    for at in (np.flatnonzero((h >> np.uint32(12)) & np.uint32(average - 1) == 0) + 1).tolist():
        while at - last > most:
            last = cut(last + most)
        if at - last >= least and at < n:
            last = cut(at)
    while n - last > most:
        last = cut(last + most)
    ends.append(n)
    return ends


def _hash(chunk: bytes) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(chunk)


def _number(key: bytes) -> int:
    """The 63 bits of a key that are counted."""
    return int.from_bytes(key[:8], "little") >> 1


def _inside(chunk: bytes) -> tuple[int, int]:
    """Places of the first and last separator (space or newline); equal when
    nothing lies between them."""
    firsts = [p for p in (chunk.find(b" "), chunk.find(b"\n")) if p >= 0]
    return (min(firsts), max(chunk.rfind(b" "), chunk.rfind(b"\n"))) if firsts else (0, 0)


def _word_start(data: bytes, at: int) -> int:
    """Place after the last separator before ``at``, looking no further back than needed."""
    width = 64
    while True:
        low = max(0, at - width)
        found = max(data.rfind(b" ", low, at), data.rfind(b"\n", low, at))
        if found >= 0 or low == 0:
            return found + 1
        width *= 4


def _word_end(data: bytes, at: int) -> int:
    """Place of the next separator from ``at`` on, or the text's end."""
    found = SEPARATOR.search(data, at)
    return found.start() if found else len(data)


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()),
                                           pa.array(list(counts.values()), pa.int64())], names=["chunk", "n"])
    counts: Counter = Counter()
    for part in slices(batches):
        for data in part.column(0).cast(pa.binary()).to_pylist():
            last = 0
            for end in cuts(data) if data else ():
                counts[_number(_hash(data[last:end]))] += 1
                last = end
        if len(counts) >= FLUSH:
            yield rows(counts)
            counts = Counter()
    yield rows(counts)


class _Shared:
    """Which chunks are encoded once: those in the bitmap (by the lexicon) and
    the hot ones (in each task)."""

    def __init__(self, rows: dict[int, bytes], hot: set[int], bits: int):
        self.bits, self.hot = bits, hot
        self.map = {at: np.frombuffer(row, np.uint8) for at, row in rows.items()}

    def kind(self, key: bytes) -> str | None:
        number = _number(key)
        if number in self.hot:
            return "hot"
        row, place = self.map.get(number % self.bits // ROW_BITS), number % ROW_BITS
        return "lexicon" if row is not None and row[place >> 3] >> (place & 7) & 1 else None


class _Cutter:
    """Texts into encoded stretches and references to shared chunks."""

    def __init__(self, path: str, shared: _Shared):
        from daybook.llm.wordbpe import encoder
        self.bpe, self.shared = encoder(path), shared
        self.hot: dict[bytes, bytes] = {}          # at most HOT_PARTS chunks

    def references(self, data: bytes) -> list[tuple[int, int, bytes, str]]:
        """(start, end, key, kind) of the insides of the shared chunks of a text
        whose borders agree."""
        found, last = [], 0
        for end in cuts(data):
            chunk = data[last:end]
            key = _hash(chunk)
            kind = self.shared.kind(key)
            if kind:
                first, final = _inside(chunk)
                if final > first and self.agrees(data, last + first) and self.agrees(data, last + final):
                    found.append((last + first, last + final, key, kind))
            last = end
        return found

    def agrees(self, data: bytes, at: int) -> bool:
        """Whether the library gives the words before and after the separator at
        ``at`` the same ids together as it gives them one by one."""
        left, right = _word_start(data, at), _word_end(data, at + 1)
        both = self.bpe.tokenizer.encode(data[left:right].decode(), add_special_tokens=False).ids
        alone = self.bpe.encode(data[left:at].decode()) + self.bpe.encode(data[at:right].decode())
        return np.array(both, "<u4").tobytes() == alone

    def segments(self, data: bytes, references: list[tuple[int, int, bytes, str]]
                 ) -> list[tuple[bytes | None, bytes]]:
        """The text in order: (None, ids) of a stretch encoded in this task, or
        (key, inside) of a shared chunk."""
        out, last = [], 0
        for start, end, key, kind in [*references, (len(data), len(data), None, None)]:
            if start > last:
                out.append((None, self.bpe.encode(data[last:start].decode())))
            if kind == "hot":
                if key not in self.hot:
                    self.hot[key] = self.bpe.encode(data[start:end].decode())
                out.append((None, self.hot[key]))
            elif kind:
                out.append((key, data[start:end]))
            last = end
        return out


def _pack(data: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(data)


def _narrow(ids: bytes) -> bytes:
    """Ids for shuffles and hand-offs: 16 bits each where all fit, compressed."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() > 0xFFFF:
        return b"4" + _pack(ids)
    return b"2" + _pack(wide.astype("<u2").tobytes())


def _wide(data: bytes) -> bytes:
    ids = _unpack(data[1:])
    return ids if data[:1] == b"4" else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def _result(bpe, ids: pa.Array, found: list[bytes]) -> pa.RecordBatch:
    """Output rows: ids, their number, and the decoded text."""
    pieces = bpe.pieces_by_id()
    numbers = [np.frombuffer(x, "<u4").tolist() for x in found]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(found, pa.binary()), pa.array([len(x) for x in numbers], pa.int64()),
         pa.array([" ".join(map(pieces.__getitem__, x)) for x in numbers], pa.string())],
        names=["id", "ids", "n_tokens", "decoded"])


_RESULT = "id bigint, ids binary, n_tokens bigint, decoded string"


def _whole(path: str, sent):
    """Texts without a chunk of the lexicon, encoded and decoded."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(path, _Shared(*sent.value))
        for part in slices(batches, SLICE):
            ids, out = [], []
            for i, data in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                found = cutter.references(data) if data else []
                if all(kind == "hot" for *_, kind in found):
                    ids.append(i)
                    out.append(b"".join(x for _, x in cutter.segments(data or b"", found)))
            yield _result(cutter.bpe, pa.array(ids, pa.int64()), out)
    return encode


def _parts(path: str, sent):
    """The other texts: keys of their shared chunks in order, the ids of all else
    with the number of ids before each key, and the insides met first in this slice."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter(path, _Shared(*sent.value))
        for part in slices(batches):
            ids, keys, before, own, insides, met = [], [], [], [], [], set()
            for i, data in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                references = cutter.references(data) if data else []
                if all(kind == "hot" for *_, kind in references):
                    continue
                stretches, places, names, new, n = [], [], [], [], 0
                for key, x in cutter.segments(data, references):
                    if key is None:
                        stretches.append(x)
                        n += len(x) // 4
                        continue
                    names.append(key)
                    places.append(n)
                    if key not in met:
                        met.add(key)
                        new.append({"key": key, "inside": _pack(x)})
                ids.append(i)
                keys.append(names)
                before.append(places)
                own.append(_narrow(b"".join(stretches)))
                insides.append(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.list_(pa.binary())),
                 pa.array(before, pa.list_(pa.int32())), pa.array(own, pa.binary()),
                 pa.array(insides, pa.list_(INSIDE))], names=["id", "keys", "before", "own", "insides"])
    return cut


def _lexicon(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from daybook.llm.wordbpe import encoder
        bpe = encoder(path)
        for part in slices(batches, 4096):
            ids = [_narrow(bpe.encode(_unpack(x).decode())) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])
    return encode


def _assemble(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from daybook.llm.wordbpe import encoder
        bpe = encoder(path)
        for part in slices(batches, SLICE):
            out = []
            for before, own, found in zip(*(part.column(n).to_pylist() for n in (1, 2, 3))):
                own, last, stretches = _wide(own), 0, []
                for at, x in zip(before, sorted(found, key=lambda x: x["seq"])):
                    stretches += [own[4 * last:4 * at], _wide(x["ids"])]
                    last = at
                out.append(b"".join([*stretches, own[4 * last:]]))
            yield _result(bpe, part.column(0), out)
    return run


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  bits: int = BITS) -> DataFrame:
    """``id_col, ids, n_tokens, decoded``: the ids of every text as little-endian
    unsigned 32-bit integers, without special tokens of the library's own, and
    the text that the library decodes them to, special tokens kept.

    ``tokenizer`` is the path of a word-level BPE file without a decoder; ids of
    documents must be integers.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    counts = handoff(docs.select("text").mapInArrow(_count_chunks, "chunk bigint, n bigint")
                     .groupBy("chunk").agg(F.sum("n").alias("n")), "chunks")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(HOT_LEAST, total / HOT_PARTS)
    hot = {r[0] for r in counts.where(F.col("n") >= least).select("chunk").collect()}  # at most HOT_PARTS
    place = F.pmod("chunk", F.lit(bits))
    rows = (counts.where((F.col("n") >= 2) & (F.col("n") < least))
            .groupBy(F.floor(place / ROW_BITS).alias("row"))
            .agg(F.bitmap_construct_agg(F.pmod(place, F.lit(ROW_BITS))).alias("bits")))
    sent = spark.sparkContext.broadcast(   # at most bits / ROW_BITS rows of 4 KB
        ({r["row"]: bytes(r["bits"]) for r in rows.collect()}, hot, bits))
    parts = handoff(
        docs.mapInArrow(_parts(tokenizer, sent),
                        "id bigint, keys array<binary>, before array<int>, own binary, "
                        "insides array<struct<key:binary,inside:binary>>")
        .withColumn("row", F.monotonically_increasing_id()), "chunk-parts")
    lexicon = (parts.select(F.explode("insides").alias("x")).select("x.key", "x.inside")
               .groupBy("key").agg(F.first("inside").alias("inside"))
               .mapInArrow(_lexicon(tokenizer), "key binary, ids binary"))
    found = (parts.select("row", F.posexplode("keys").alias("seq", "key")).join(lexicon, "key")
             .groupBy("row").agg(F.collect_list(F.struct("seq", "ids")).alias("found")))
    joined = (parts.select("row", "id", "before", "own").join(found, "row")
              .select("id", "before", "own", "found").mapInArrow(_assemble(tokenizer), _RESULT))
    whole = docs.mapInArrow(_whole(tokenizer, sent), _RESULT)
    return whole.unionByName(joined).withColumnRenamed("id", id_col)
