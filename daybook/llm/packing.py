"""Best-fit packing of documents into token sequences of a fixed capacity.

The tokens of a document are its ids and one separator id.  Only documents
longer than the capacity are cut.  Lengths are whole numbers up to the
capacity, so the packing is decided on the histogram of lengths (at most
``capacity`` classes, whatever the number of documents):

* pieces above one third of the capacity: at most two share a sequence.  From
  the longest down, each class is matched with the longest class that fits;
* the other pieces, from the longest down, each go to the sequence with the
  smallest gap that holds them, whole classes at a time; a new sequence is
  opened only if no gap is large enough.

The result is a list of intervals "pieces number a to b of length l go to
sequences s, s+1, ... at offset o, q to a sequence", a few thousand rows.
Every piece then finds its place from its number among the pieces of its
length.  Numbers are dealt by (length, salt), so that a length that a third of
the pieces have is numbered by many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import handoff, slices

CAPACITY = 2048
SEPARATOR = 0
SALTS = 256
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Intervals ``(length, first, last, per_sequence, sequence, offset)``.

    ``histogram`` is length -> number of pieces, lengths from 1 to ``capacity``.
    Pieces ``first <= number < last`` of a length go to consecutive sequences
    from ``sequence`` on, ``per_sequence`` to each, from ``offset`` on.
    """
    left = {length: n for length, n in histogram.items() if n}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("a length is outside 1..capacity")
    used: dict[int, int] = defaultdict(int)
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []                                     # sorted gaps that have groups
    groups: dict[int, list[tuple[int, int]]] = {}            # gap -> [(first sequence, how many)]
    opened = 0

    def put(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        out.append((length, used[length], used[length] + n, each, sequence, offset))
        used[length] += n

    def keep(gap: int, sequence: int, n: int) -> None:
        if n and gap:
            if gap not in groups:
                groups[gap] = []
                bisect.insort(gaps, gap)
            groups[gap].append((sequence, n))

    large = sorted((length for length in left if 3 * length > capacity))
    while large:
        a = large[-1]
        at = bisect.bisect_right(large, capacity - a) - 1    # the longest that fits beside it
        n = left[a]
        if at < 0:
            put(a, n, 1, opened, 0)
            keep(capacity - a, opened, n)
            opened += n
            large.pop()
            continue
        b = large[at]
        pairs = n // 2 if a == b else min(n, left[b])
        if pairs == 0:                                       # one left, of a class that pairs with itself
            if at == 0:
                put(a, 1, 1, opened, 0)
                keep(capacity - a, opened, 1)
                opened += 1
                large.pop()
                continue
            b, pairs = large[at - 1], 1
        put(a, pairs, 1, opened, 0)
        put(b, pairs, 1, opened, a)
        keep(capacity - a - b, opened, pairs)
        opened += pairs
        for x in {a, b}:
            left[x] -= pairs * (2 if a == b else 1)
            if not left[x]:
                large.remove(x)
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                need = -(-n // (capacity // length))
                keep(capacity, opened, need)
                opened += need
                continue
            gap = gaps[at]
            sequence, count = groups[gap].pop()
            if not groups[gap]:
                del groups[gap], gaps[at]
            each = gap // length
            full = min(count, n // each)
            if full:
                put(length, full * each, each, sequence, capacity - gap)
                keep(gap - each * length, sequence, full)
                n -= full * each
            if full < count and n:                           # fewer than ``each`` are left
                put(length, n, n, sequence + full, capacity - gap)
                keep(gap - n * length, sequence + full, 1)
                full, n = full + 1, 0
            keep(gap, sequence + full, count - full)
    return out


def _encode(path: str, capacity: int, separator: int):
    tail = int(separator).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from daybook.llm.wordbpe import encoder
        encode = encoder(path).encode
        for part in slices(batches):
            rows = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = encode(text or "") + tail
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    rows.append((doc, i, at // 4, len(own) // 4, zlib.crc32(own)))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                       pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return pieces


def _place(first, spans):
    """Adds sequence and offset to rows that carry ``length, salt, number``."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, keys, table = first.value, *spans.value
        for b in batches:
            length, salt, number = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 5, 6))
            rank = base[length, salt] + number - 1
            row = table[np.searchsorted(keys, (length.astype(np.int64) << 44) + rank, side="right") - 1]
            step, own = np.divmod(rank - row[:, 1], row[:, 3])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(row[:, 4] + step), pa.array(row[:, 5] + own * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text is empty and packs as its separator alone.  Every row of
    ``docs`` is packed: rows with equal or null ids are packed separately.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = handoff(docs.mapInArrow(_encode(tokenizer, capacity, separator), PIECES)
                     .withColumn("row", F.monotonically_increasing_id()), "pieces")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    # at most capacity x SALTS rows
    counts = pieces.groupBy("length", "salt").count().toPandas()
    table = np.zeros((capacity + 1, SALTS), dtype=np.int64)
    table[counts["length"].to_numpy(), counts["salt"].to_numpy()] = counts["count"].to_numpy()
    total = table.sum(axis=1)
    spans = sorted(plan({i: int(n) for i, n in enumerate(total) if n}, capacity))
    spans = np.array(spans, dtype=np.int64).reshape(-1, 6)
    keys = (spans[:, 0] << 44) + spans[:, 1]
    first = np.cumsum(table, axis=1) - table
    send = spark.sparkContext.broadcast
    numbered = pieces.withColumn("number", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("row"))).drop("row")
    return numbered.mapInArrow(_place(send(first), send((keys, spans))),
                               PIECES + ", sequence_id bigint, offset bigint")
