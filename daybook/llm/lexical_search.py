"""Ranked lexical search: MaxScore over segments, with bounds for pairs of terms.

1. Segments: each task turns runs of up to ``SEGMENT_DOCS`` documents into one
   row of postings (term, places, frequencies) of the terms that the items ask
   for, with the length of every document.  The table is written once.
2. N, L and every term's document frequency are sums over that table.
3. Index: per segment the impact of every posting, the largest impact of every
   term, and intersection lists: for pairs of terms the documents that hold
   both, with the pair's joint largest impact.  Pairs are neighbours when the
   terms of an item stand in order of weight.  Written once as well.
4. Search, per segment and item: disjoint pairs are chosen where they lower the
   sum of bounds the most; a segment whose sum of bounds is under the item's
   20th score so far is skipped.  Otherwise the units (pairs or terms) of the
   smallest bounds, as long as their sum stays under that score, are left out
   of the candidates; these are scored by the other units first and dropped as
   soon as their score and the remaining bounds are under it.  A pair's list
   adds both impacts at once.  Documents at the very score stay, so equal
   scores come out right.
5. The best of each task meet in a window per item (limited in each task).

Items are taken in blocks of a bounded number of terms; a block's terms are all
that is broadcast.  Scores are integers, exact.

Null texts have no terms: such documents are never found and count in neither
N nor L, and such items give no rows; so do items without a term of any
document.  Empty tables give an empty result.  Repeated document rows are
ranked each by itself.  Rows of one item id with the same text are one item;
with different texts each has its own ranking.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import handoff, slices

#: Bounds of a segment: places take 16 bits, and a row stays at a few MB.
SEGMENT_DOCS = 4096
SEGMENT_POSTINGS = 250_000
#: Terms of one block of items; a broadcast of at most so many strings.
BLOCK_TERMS = 200_000
MAX_TERM = 256        # bytes; longer terms are kept by their hash

#: ASCII other than letters and digits becomes a space, A-Z a-z.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a text in order: runs of letters, digits and everything
    beyond ASCII, with A-Z lower-cased."""
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(FOLD).split()


def _name(term: bytes) -> bytes:
    """What stands for a term in tables: itself, or its hash if it is very long."""
    if len(term) <= MAX_TERM:
        return term
    import hashlib
    return b" " + hashlib.sha256(term).digest()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --------------------------------------------------------------------------- segments

_SEGMENT = ("n_docs bigint, n_terms bigint, doc_ids array<bigint>, lengths array<bigint>, "
            "terms array<binary>, ends array<int>, places binary, tfs binary")


def _list(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def _segments(sent):
    """Rows of ``_SEGMENT``: documents of a run with a term of the block, in order."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value

        def row(n_docs, n_terms, ids, lengths, postings) -> pa.RecordBatch:
            names = sorted(postings)
            at = [np.array(postings[t][0], np.uint16) for t in names]
            tf = [np.array(postings[t][1], np.int32) for t in names]
            ends = np.cumsum([len(x) for x in at], dtype=np.int64).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()), _list(ids, pa.int64()),
                 _list(lengths, pa.int64()), _list(names, pa.binary()), _list(ends, pa.int32()),
                 pa.array([b"".join(x.tobytes() for x in at)], pa.binary()),
                 pa.array([b"".join(x.tobytes() for x in tf)], pa.binary())],
                names=["n_docs", "n_terms", "doc_ids", "lengths", "terms", "ends", "places", "tfs"])
        n_docs = n_terms = n_postings = 0
        ids, lengths, postings = [], [], {}
        for part in slices(batches):
            for i, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                found = terms(text)
                if not found:
                    continue
                n_docs += 1
                n_terms += len(found)
                counts = Counter(t for t in map(_name, found) if t in wanted)
                if not counts:
                    continue
                for t, tf in counts.items():
                    at, tfs = postings.setdefault(t, ([], []))
                    at.append(len(ids))
                    tfs.append(tf)
                ids.append(i)
                lengths.append(len(found))
                n_postings += len(counts)
                if len(ids) >= SEGMENT_DOCS or n_postings >= SEGMENT_POSTINGS:
                    yield row(n_docs, n_terms, ids, lengths, postings)
                    n_docs = n_terms = n_postings = 0
                    ids, lengths, postings = [], [], {}
        if n_docs:
            yield row(n_docs, n_terms, ids, lengths, postings)
    return build


def segments(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """Postings of ``vocabulary`` over all ``docs``, one row a run of documents."""
    sent = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return handoff(rows.mapInArrow(_segments(sent), _SEGMENT), "segments")


def statistics(table: DataFrame) -> tuple[int, int, dict[bytes, int]]:
    """N, L, and the document frequency of every term of the block."""
    n, length = table.agg(F.coalesce(F.sum("n_docs"), F.lit(0)),
                          F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    counts = F.transform(F.sequence(F.lit(1), F.size("ends")),
                         lambda i: F.element_at("ends", i) - F.when(i == 1, 0).otherwise(
                             F.try_element_at("ends", i - 1)))
    df = (table.where(F.size("terms") > 0)
          .select(F.explode(F.arrays_zip(F.col("terms").alias("term"), counts.alias("n"))).alias("x"))
          .groupBy(F.col("x.term").alias("term")).agg(F.sum("x.n").alias("df")))
    return n, length, {bytes(r["term"]): r["df"] for r in df.collect()}   # at most BLOCK_TERMS


# --------------------------------------------------------------------------- index

#: ``shares`` are impacts without the term's weight; pair_at_a and pair_at_b are
#: places in the two terms' postings.
_INDEX = ("doc_ids array<bigint>, terms array<binary>, weights array<bigint>, ends array<int>, places binary, "
          "shares binary, top array<bigint>, pair_a array<int>, pair_b array<int>, pair_top array<bigint>, "
          "pair_ends array<int>, pair_at_a binary, pair_at_b binary")


def item_pairs(items: list[Counter], weights: dict[bytes, int]) -> dict[bytes, list[bytes]]:
    """Pairs with an intersection list: neighbours among an item's terms in order
    of weight, greatest first (equal weights by the term); keyed by the lesser."""
    pairs: dict[bytes, set[bytes]] = {}
    for item in items:
        order = sorted((t for t in item if weights.get(t)), key=lambda t: (-weights[t], t))
        for a, b in zip(order, order[1:]):
            pairs.setdefault(min(a, b), set()).add(max(a, b))
    return {a: sorted(bs) for a, bs in pairs.items()}


def _impacts(sent):
    """Segments into index rows: impacts, their maxima, intersection lists."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, weights, pairs = sent.value
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            m = np.array([75 + (25 * x * n) // total for x in row["lengths"]], np.int64)
            at = np.frombuffer(row["places"], np.uint16)
            tf = np.frombuffer(row["tfs"], np.int32).astype(np.int64)
            names = row["terms"]
            starts = [0, *row["ends"]]
            shares = 1_000_000_000 * tf // (1000 * tf + 12 * m[at])
            weight_of = [weights[t] for t in names]
            top = [w * int(shares[a:b].max()) for w, a, b in zip(weight_of, starts, starts[1:])]
            number = {t: k for k, t in enumerate(names)}
            place_in_a = np.full(len(m), -1, np.int64)
            pair_a, pair_b, pair_top, pair_ends, at_a, at_b = [], [], [], [], [], []
            end = 0
            for a, bs in pairs.items():
                ka = number.get(a)
                if ka is None:
                    continue
                own = slice(starts[ka], starts[ka + 1])
                place_in_a[at[own]] = np.arange(own.stop - own.start)
                for b in bs:
                    kb = number.get(b)
                    if kb is None:
                        continue
                    other = slice(starts[kb], starts[kb + 1])
                    there = place_in_a[at[other]]
                    in_b = np.flatnonzero(there >= 0)
                    in_a = there[in_b]
                    joint = weight_of[ka] * shares[own][in_a] + weight_of[kb] * shares[other][in_b]
                    most = int(joint.max(initial=0))
                    if most >= top[ka] + top[kb]:
                        continue                      # tells nothing that the terms don't
                    pair_a.append(ka)
                    pair_b.append(kb)
                    pair_top.append(most)
                    at_a.append(in_a.astype(np.uint16).tobytes())
                    at_b.append(in_b.astype(np.uint16).tobytes())
                    end += len(in_b)
                    pair_ends.append(end)
                place_in_a[at[own]] = -1
            yield pa.RecordBatch.from_arrays(
                [_list(row["doc_ids"], pa.int64()), _list(names, pa.binary()), _list(weight_of, pa.int64()),
                 _list(row["ends"], pa.int32()), pa.array([row["places"]], pa.binary()),
                 pa.array([shares.astype(np.int32).tobytes()], pa.binary()),
                 _list(top, pa.int64()), _list(pair_a, pa.int32()), _list(pair_b, pa.int32()),
                 _list(pair_top, pa.int64()), _list(pair_ends, pa.int32()),
                 pa.array([b"".join(at_a)], pa.binary()), pa.array([b"".join(at_b)], pa.binary())],
                names=["doc_ids", "terms", "weights", "ends", "places", "shares", "top", "pair_a", "pair_b",
                       "pair_top", "pair_ends", "pair_at_a", "pair_at_b"])
    return build


# --------------------------------------------------------------------------- search

class Segment:
    """One index row, opened for look-ups."""

    def __init__(self, row: dict):
        self.ids = np.array([-1 if i is None else i for i in row["doc_ids"]], np.int64)
        self.null = np.array([i is None for i in row["doc_ids"]], bool)
        self.number = {t: k for k, t in enumerate(row["terms"])}
        self.starts, self.top = [0, *row["ends"]], row["top"]
        self.places = np.frombuffer(row["places"], np.uint16)
        self.impacts = np.frombuffer(row["shares"], np.int32) * np.repeat(
            np.array(row["weights"], np.int64), np.diff(self.starts))
        self.pairs = {ab: k for k, ab in enumerate(zip(row["pair_a"], row["pair_b"]))}
        self.pair_top, self.pair_starts = row["pair_top"], [0, *row["pair_ends"]]
        self.pair_at = [np.frombuffer(row[name], np.uint16) for name in ("pair_at_a", "pair_at_b")]
        self.scores = np.zeros(len(self.ids), np.int64)

    def term(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.starts[k], self.starts[k + 1])
        return self.places[own], self.impacts[own]

    def pair(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold both terms; the impacts of either."""
        p = self.pairs[a, b]
        own = slice(self.pair_starts[p], self.pair_starts[p + 1])
        (at, one), (_, two) = self.term(a), self.term(b)
        in_a, in_b = self.pair_at[0][own], self.pair_at[1][own]
        return at[in_a], one[in_a], two[in_b]


def units(segment: Segment, item: list[tuple[bytes, int]]) -> list[tuple[int, tuple]]:
    """(bound, ((term, repeats), ...)) of disjoint pairs and single terms of an item.

    A pair's bound is the most that a document can get from both terms: the
    joint maximum where they meet, or either's own maximum.  Pairs that lower
    the sum the most are taken first.
    """
    here = [(segment.number[t], q) for t, q in item if t in segment.number]
    alone = {k: q * segment.top[k] for k, q in here}
    repeats = dict(here)
    saved = []
    for (a, _), (b, _) in zip(here, here[1:]):
        a, b = min(a, b), max(a, b)
        p = segment.pairs.get((a, b))
        if p is None:
            continue
        least = min(repeats[a], repeats[b])
        joint = least * segment.pair_top[p] + (repeats[a] - least) * segment.top[a] + (repeats[b] - least) * segment.top[b]
        bound = max(alone[a], alone[b], joint if segment.pair_top[p] else 0)
        if bound < alone[a] + alone[b]:
            saved.append((alone[a] + alone[b] - bound, bound, a, b))
    out, used = [], set()
    for _, bound, a, b in sorted(saved, key=lambda x: (-x[0], x[2], x[3])):
        if a not in used and b not in used:
            used |= {a, b}
            out.append((bound, ((a, repeats[a]), (b, repeats[b]))))
    out += [(bound, ((k, repeats[k]),)) for k, bound in alone.items() if k not in used]
    return sorted(out)


def _add(segment: Segment, unit: tuple, alive: np.ndarray, scores: np.ndarray) -> None:
    """Add what a unit gives the documents ``alive`` (places in order) to ``scores``."""
    for k, q in unit:
        at, impacts = segment.term(k)
        where = np.searchsorted(at, alive)
        where[where == len(at)] = 0
        hit = at[where] == alive
        scores[hit] += q * impacts[where[hit]]


def _add_pair(segment: Segment, unit: tuple, alive: np.ndarray, scores: np.ndarray) -> None:
    """The same for a pair: the intersection list first, then documents with one term only."""
    (a, qa), (b, qb) = unit
    at, one, two = segment.pair(a, b)
    rest = np.ones(len(alive), bool)
    if len(at):
        where = np.searchsorted(at, alive)
        where[where == len(at)] = 0
        hit = at[where] == alive
        scores[hit] += qa * one[where[hit]] + qb * two[where[hit]]
        rest = ~hit
    some, more = alive[rest], scores[rest]
    _add(segment, unit, some, more)
    scores[rest] = more


def search_segment(segment: Segment, item: list[tuple[bytes, int]], floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of all documents that score ``floor`` or more (and above 0)."""
    none = np.zeros(0, np.int64)
    order = units(segment, item)
    bounds = [bound for bound, _ in order]
    if not order or sum(bounds) < floor:
        return none, none
    left = 0                                 # units whose bounds together stay under the floor
    below = 0
    while left < len(order) and below + bounds[left] < floor:
        below += bounds[left]
        left += 1
    scores = segment.scores
    touched = []
    for _, unit in order[left:]:
        for k, q in unit:
            at, impacts = segment.term(k)
            scores[at] += q * impacts
            touched.append(at)
    if not touched:
        return none, none
    alive = np.flatnonzero(scores) if len(touched) > 8 else np.unique(np.concatenate(touched))
    found = scores[alive]
    for at in touched:
        scores[at] = 0
    for bound, unit in reversed(order[:left]):
        keep = found + below >= floor
        alive, found = alive[keep], found[keep]
        if not len(alive):
            return none, none
        (_add_pair if len(unit) == 2 else _add)(segment, unit, alive, found)
        below -= bound
    keep = (found >= floor) & (found > 0)
    return alive[keep], found[keep]


def _search(sent, k: int):
    """The ``k`` best documents of each item over all segments of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        best: dict[int, list[tuple[int, bool, int]]] = {}      # item -> (-score, id is null, id), best first
        for batch in slices(batches, 1):
            segment = Segment(batch.to_pylist()[0])
            for n, (_, item) in enumerate(items):
                so_far = best.get(n, [])
                floor = -so_far[-1][0] if len(so_far) >= k else 1
                at, scores = search_segment(segment, item, floor)
                if len(at):
                    if len(at) > k:                 # all that reach this segment's k-th score
                        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                        at, scores = at[scores >= cut], scores[scores >= cut]
                    new = zip((-scores).tolist(), segment.null[at].tolist(), segment.ids[at].tolist())
                    best[n] = sorted([*so_far, *new])[:k]
        rows = [(n, None if null else i, -s) for n, found in best.items() for s, null, i in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64())], names=["item", "doc_id", "score"])
    return run


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items in blocks of at most BLOCK_TERMS different terms (one item at least)."""
    rows = (items.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
            .where(F.col("text").isNotNull()).distinct().orderBy("id", "text"))
    block, words = [], 0
    for r in rows.toLocalIterator():
        counts = Counter(map(_name, terms(r["text"])))
        if block and words + len(counts) > BLOCK_TERMS:
            yield block
            block, words = [], 0
        if counts:
            block.append((r["id"], counts))
            words += len(counts)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item.

    Document and item ids must be integers.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], f"`{item_col}` bigint, rank int, `{id_col}` bigint, score bigint")
    for block in _blocks(items, item_col, item_text_col):
        vocabulary = sorted({t for _, counts in block for t in counts})
        table = segments(docs, vocabulary, id_col, text_col)
        n, length, df = statistics(table)
        weights = {t: weight(n, x) for t, x in df.items()}
        pairs = item_pairs([counts for _, counts in block], weights)
        sent = spark.sparkContext.broadcast((n, length, weights, pairs))
        index = handoff(table.where(F.size("terms") > 0)
                        .select("doc_ids", "lengths", "terms", "ends", "places", "tfs")
                        .mapInArrow(_impacts(sent), _INDEX), "index")
        # terms in the order of item_pairs, so that neighbours are the listed pairs
        asked = [(i, sorted(((t, q) for t, q in counts.items() if weights.get(t)),
                            key=lambda x: (-weights[x[0]], x[0]))) for i, counts in block]
        found = index.mapInArrow(_search(spark.sparkContext.broadcast(asked), k),
                                 "item bigint, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(asked)], "item bigint, name bigint")
        ranked = (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                  .join(F.broadcast(names), "item")               # as many rows as the block has items
                  .select(F.col("name").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"))
        out = out.unionByName(ranked)
    return out
