"""Near duplicates: an LSH forest of MinHash signatures, confirmed on full sets.

A document's set holds its distinct word shingles (64-bit hashes of the lower-cased
words).  Documents with equal sets are one node.  Every node gets ``TREES``
MinHash signatures of eight bytes and ``SKETCH`` further bytes.  Its sketch holds
the low two bits of every one of these ``HASHES`` bytes: at the same width they
estimate the similarity better than whole bytes of a quarter of them.

* Forest: for each tree, all nodes are sorted by signature (range partitions:
  also a region of equal signatures is spread over tasks).  A node's candidates
  are its neighbours in the order, that is those with the longest common
  prefix.  So the depth adapts: in a sparse region neighbours share a short
  prefix, in a crowded one a long prefix.  A candidate goes on if sizes and
  sketches allow the similarity.
* Round one takes only the next neighbour in each tree, and of these the
  likeliest for each node, and confirms them on full sets.  Round two sorts the
  nodes again, each with its component so far, and takes the ``NEIGHBOURS`` on
  either side that belong to another component; of these, again, the likeliest
  are confirmed first, and then those that still join two components.  The rows of either round grow
  with the nodes: a group of thousands of near copies has become one component,
  and its pairs are skipped inside the sorted scan.
* Crowded regions: where nodes that share a tree's whole signature are still in
  different components, the signature is extended.  First every node is
  compared with the node of the region that has most links.  Then the region's
  nodes are sorted again, in ``ORDERS`` orders, by eight further bytes each, and
  the ``NEIGHBOURS`` on either side in another component are candidates: they
  share the tree's signature and the longest prefix of the further bytes, so
  the depth follows the region's crowding.  All of this grows with the nodes.
  A pair at similarity 0.8 shares one of ``TREES`` whole signatures with a
  probability of 0.988.  In a region whose members are near 0.7 to each other
  a node meets a given partner at 0.8 or more with a probability that falls
  from about 1 for thousands of members as the region grows; one link to the
  partner's component is enough.
* Components come from star steps (:mod:`daybook.llm.components`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import forget, handoff, slices
from daybook.llm.components import components

TREES = 24
DEPTH = 8                 # bytes of a tree's signature: a 64-bit sort key
SKETCH = 64
HASHES = TREES * DEPTH + SKETCH
SKETCH_LEAST = 194        # of HASHES equal pairs of bits; at similarity 0.8 fewer come in one of 25,000 pairs
NEIGHBOURS = 8
ORDERS = 4                # further sort orders of a crowded region, eight bytes each
MAX_BROADCAST_IDS = 1_000_000
#: Bytes of the words whose hashes a task remembers, 64 or so more for each of them.
MAX_REMEMBERED = 4 << 20


class Words:
    """Hashes of words, remembered in a bounded number of bytes while a task runs."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.size = 0

    def hashes(self, text: str | None) -> np.ndarray:
        """64-bit hashes of the words (runs without ASCII white space, A-Z lower-cased)."""
        import xxhash
        if not text:
            return np.zeros(0, np.uint64)
        words = text.encode().lower().split()
        found = list(map(self.known.get, words))
        if None in found:
            for i, h in enumerate(found):
                if h is None:
                    found[i] = h = xxhash.xxh64_intdigest(words[i])
                    if self.size > MAX_REMEMBERED:
                        self.known, self.size = {}, 0
                    self.known[words[i]] = h
                    self.size += len(words[i]) + 16
        return np.array(found, dtype=np.uint64)


_MEMORY = Words()


def word_hashes(text: str | None) -> np.ndarray:
    """:meth:`Words.hashes` with one memory for the process."""
    return _MEMORY.hashes(text)


def shingles(text: str | None, size: int = 2, memory: Words | None = None) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer words the whole sequence is one."""
    words = (memory or _MEMORY).hashes(text)
    if not len(words):
        return words
    own = min(size, len(words))
    out = np.zeros(len(words) - own + 1, np.uint64)
    for i in range(own):
        out = (out ^ words[i:len(words) - own + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out + np.uint64(own))


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(6)
    return (rng.integers(1 << 31, 1 << 32, n, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint32))


def signature(values: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """One byte for each hash function: the low byte of the (mixed) minimum."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):                      # long texts: bounded memory
        part = low[at:at + 2048]
        best = np.minimum(best, (part[None, :] * mul[:, None] + add[:, None]).min(axis=1))
    best = best * np.uint32(0x85EBCA6B)
    return (best >> np.uint32(24)).astype(np.uint8)


def _nodes(size: int):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        mul, add = _constants(HASHES)
        memory = Words()
        for part in slices(batches, 128):
            n, digest, sig = [], [], []
            for text in part.column(1).to_pylist():
                own = shingles(text, size, memory)
                n.append(len(own))
                if len(own):
                    digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    sig.append(signature(own, mul, add).tobytes())
                else:
                    digest.append(None)
                    sig.append(None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "digest", "sig"])
    return nodes


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Words()
        for part in slices(batches, 128):
            own = [shingles(t, size, memory).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.binary())],
                                             names=["node", "members"])
    return sets


def _tree_keys(sig: np.ndarray) -> np.ndarray:
    """Sort keys of the trees, a column each, of signatures (a row each)."""
    n = len(sig)
    keys = np.ascontiguousarray(sig[:, :TREES * DEPTH].reshape(n, TREES, DEPTH)).view(">u8")
    return (keys.reshape(n, TREES).astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _sketch(sig: np.ndarray) -> np.ndarray:
    """The low two bits of each byte of signatures (a row each), four to a byte."""
    two = sig & np.uint8(3)
    return two[:, ::4] | two[:, 1::4] << 2 | two[:, 2::4] << 4 | two[:, 3::4] << 6


def _equal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many pairs of bits are equal, of sketches in the rows of either side."""
    other = np.ascontiguousarray(x ^ y).view(np.uint64)
    other = (other | other >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return HASHES - np.bitwise_count(other).sum(axis=1, dtype=np.int64)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tree and node: tree, sort key, node, label, size, sketch."""
    for part in slices(batches):
        sig = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(part.num_rows, -1)
        keys = _tree_keys(sig)
        sketch = [s.tobytes() for s in _sketch(sig)]
        for tree in range(TREES):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sig), tree, np.int32)), pa.array(keys[:, tree].copy()), part.column(0),
                 part.column(1), part.column(2), pa.array(sketch, pa.binary())],
                names=["tree", "key", "node", "label", "n", "sketch"])


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tree, sort key, node and label: the forest without what comparing needs."""
    for part in slices(batches):
        keys = _tree_keys(np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, -1))
        for tree in range(TREES):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(part.num_rows, tree, np.int32)), pa.array(keys[:, tree].copy()), part.column(0),
                 part.column(1)], names=["tree", "key", "node", "label"])


def _neighbours(percent: int, reach: int, regions: bool = False):
    """Candidate pairs among neighbours in sort order that are in different components,
    with the equal parts of their sketches; ``regions``: of the same whole signature only."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part in slices(batches, 20_000):
            own = [*(part.column(i).to_numpy() for i in (0, 1, 2, 3, 4)),
                   np.frombuffer(b"".join(part.column(5).to_pylist()), np.uint8).reshape(part.num_rows, -1)]
            before = 0
            if last is not None:
                before = len(last[0])
                own = [np.concatenate(x) for x in zip(last, own)]
            tree, key, node, label, n, sketch = own
            a, b, equal = [], [], []
            for step in range(1, min(reach, len(node) - 1) + 1):
                i = np.arange(max(0, before - step), len(node) - step)   # pairs that end in this slice
                j = i + step
                low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                fit = (tree[i] == tree[j]) & (100 * low >= percent * high) & (label[i] != label[j])
                if regions:
                    fit &= key[i] == key[j]
                i, j = i[fit], j[fit]
                same = _equal(sketch[i], sketch[j])
                fit = same >= SKETCH_LEAST
                a.append(np.minimum(node[i], node[j])[fit])
                b.append(np.maximum(node[i], node[j])[fit])
                equal.append(same[fit])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)), pa.array(np.concatenate(b)),
                     pa.array(np.concatenate(equal).astype(np.int32))], names=["a", "b", "equal"])
            last = [x[-reach:] for x in own]
    return pairs


def _labelled(heads: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``node, label, n, sig``: every node with its component so far (itself at first)."""
    if labels is None:
        return heads.select("node", F.col("node").alias("label"), "n", "sig")
    found = labels.select("node", F.col("component").alias("_c"))
    return heads.join(found, "node", "left").select("node", F.coalesce("_c", "node").alias("label"), "n", "sig")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with their sketch and the further bytes that ``ORDERS`` sort orders take, instead of the signature."""
    for part in slices(batches):
        sig = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(part.num_rows, -1)
        further = sig[:, TREES * DEPTH:TREES * DEPTH + 8 * ORDERS]
        yield pa.RecordBatch.from_arrays(
            [*part.columns[:3], *(pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (_sketch(sig), further))],
            names=["node", "label", "n", "sketch", "further"])


def _crowded(heads: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes of the regions (tree, whole signature) that lie in more than one component.

    Regions are found on narrow rows; only their nodes get their sketches again.
    """
    nodes = handoff(_labelled(heads, labels), "labelled")
    places = nodes.select("node", "label", "sig").mapInArrow(_regions, "tree int, key bigint, node bigint, label bigint")
    regions = handoff(places.groupBy("tree", "key").agg(
        F.count("*").alias("size"), F.min("label").alias("_lo"), F.max("label").alias("_hi"))
        .where("_lo != _hi").select("tree", "key", "size"), "regions")
    found = places.select("tree", "key", "node").join(regions, ["tree", "key"])
    sketched = nodes.select("node", "label", "n", "sig").mapInArrow(
        _sketches, "node bigint, label bigint, n bigint, sketch binary, further binary")
    return found.join(sketched, "node").select("tree", "key", "node", "label", "n", "sketch", "further", "size")


def _fitting(percent: int):
    """Pairs (node, n, sketch of either side) whose sizes and sketches allow the similarity."""
    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            a, b, n, m = (part.column(i).to_numpy() for i in range(4))
            x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    for i in (4, 5))
            same = _equal(x, y)
            fit = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (same >= SKETCH_LEAST)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)[fit]), pa.array(np.maximum(a, b)[fit]),
                 pa.array(same[fit].astype(np.int32))], names=["a", "b", "equal"])
    return fitting


def _fit(pairs: DataFrame, percent: int) -> DataFrame:
    return (pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(_fitting(percent), "a bigint, b bigint, equal int")
            .groupBy("a", "b").agg(F.max("equal").alias("equal")))


def _hub_pairs(crowded: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Pairs of each node of a crowded region with the region's most linked node, if in another component."""
    degree = (links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count("*").alias("degree")))
    ranked = crowded.join(degree, "node", "left").groupBy("tree", "key").agg(F.max(F.struct(
        F.coalesce("degree", F.lit(0)).alias("degree"), "node", "label", "n", "sketch")).alias("hub"))
    return _fit(crowded.join(ranked, ["tree", "key"]).where("label != hub.label").select(
        F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.n").alias("n"), F.col("n").alias("m"),
        F.col("hub.sketch").alias("x"), F.col("sketch").alias("y")), percent)


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of crowded regions in each further order: region, order, its eight bytes."""
    for part in slices(batches, 4096):
        n = part.num_rows
        further = np.frombuffer(b"".join(part.column(6).to_pylist()), np.uint8)
        keys = further.reshape(n, ORDERS, 8).view(">u8").reshape(n, ORDERS)
        keys = (keys.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
        tree = part.column(0).to_numpy()
        for order in range(ORDERS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree * ORDERS + order, pa.int32()), part.column(1), part.column(2), part.column(3),
                 part.column(4), part.column(5), pa.array(keys[:, order].copy())],
                names=["tree", "key", "node", "label", "n", "sketch", "deeper"])


def _deeper_pairs(crowded: DataFrame, percent: int) -> DataFrame:
    """Candidates of crowded regions: neighbours by region and further bytes."""
    rows = crowded.select("tree", "key", "node", "label", "n", "sketch", "further").mapInArrow(
        _deeper, "tree int, key bigint, node bigint, label bigint, n bigint, sketch binary, deeper bigint")
    order = ["tree", "key", "deeper", "node"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("tree", "key", "node", "label", "n", "sketch")
            .mapInArrow(_neighbours(percent, NEIGHBOURS, regions=True), "a bigint, b bigint, equal int")
            .groupBy("a", "b").agg(F.max("equal").alias("equal")))


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keep = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return confirm


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    return (pairs.select("a", "b")
            .join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a bigint, b bigint"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """``a, b, place``: pairs with their place among those of a node with smaller ones, the likeliest first."""
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("equal"), "a"))
    return pairs.select("a", "b", place.alias("place"))


def _best(ranked: DataFrame) -> DataFrame:
    """Each node's likeliest pair with a smaller node."""
    return ranked.where("place = 1").select("a", "b")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    of = [labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in ("a", "b")]
    return (pairs.join(of[0], "a", "left").join(of[1], "b", "left")
            .where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents with similarity ``percent`` or more (of their sets of ``size``-word
    shingles) are linked; ``component_id`` is the smallest id reachable, and the
    document with that id is kept.  Texts that are null or without words are
    linked with nothing and kept.  Rows with a null id take no part: kept, with
    a null component.  Rows with equal ids count as one document.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    nodes = handoff(docs.mapInArrow(_nodes(size), "doc_id bigint, n_shingles bigint, digest binary, sig binary"),
                    "nodes")
    full = nodes.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = handoff(full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")),
                      "classes")
    heads = handoff(full.join(classes, [full["digest"] == classes["digest"], F.col("doc_id") == F.col("node")])
                    .groupBy("node", "n_shingles", "sig").agg(F.lit(1))
                    .select("node", F.col("n_shingles").alias("n"), "sig"), "heads")

    def candidates(labels: DataFrame | None, reach: int) -> DataFrame:
        forest = _labelled(heads, labels).mapInArrow(
            _trees, "tree int, key bigint, node bigint, label bigint, n bigint, sketch binary")
        return (forest.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
                .mapInArrow(_neighbours(percent, reach), "a bigint, b bigint, equal int")
                .groupBy("a", "b").agg(F.max("equal").alias("equal")))

    def sets_of(pairs: DataFrame) -> DataFrame:
        wanted = handoff(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "wanted")
        if wanted.count() <= MAX_BROADCAST_IDS:               # 8 bytes each; beyond, a shuffled join
            wanted = F.broadcast(wanted)
        return handoff(docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text")
                       .mapInArrow(_sets(size), "node bigint, members binary").distinct(), "sets")

    # the classes of one id with several texts hang together through their id
    several = (full.select("doc_id", F.xxhash64("digest").alias("h")).groupBy("doc_id")
               .agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least != most").select("doc_id"))
    links = (full.select("doc_id", "digest").join(several, "doc_id").join(classes, "digest")
             .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    confirmed, found = [], None

    def settle(pairs: DataFrame) -> None:
        """Confirm pairs and bring the components up to date."""
        nonlocal found, links
        confirmed.append(handoff(_confirmed(pairs, sets_of(pairs), percent), "confirmed"))
        if found is None or not confirmed[-1].isEmpty():
            found = components(links.unionByName(confirmed[-1]))
            # a link from each node to its component says all that the links so far did
            links = found.select(F.col("node").alias("a"), F.col("component").alias("b"))

    def settle_all(pairs: DataFrame) -> None:
        """Each node's likeliest pairs, then those of the others that still lie in two components."""
        ranked = handoff(_ranked(pairs), "ranked")
        settle(_best(ranked))
        rest = handoff(_apart(ranked.where("place > 1"), found), "rest")
        if not rest.isEmpty():
            settle(rest)

    first = handoff(_best(_ranked(candidates(None, 1))), "chosen")
    settle(first)
    chosen = handoff(candidates(found, NEIGHBOURS).join(first, ["a", "b"], "left_anti"), "chosen")
    if not chosen.isEmpty():
        settle_all(chosen)
    # crowded regions: what the neighbours in sort order have not compared
    for hubs in (True, False):
        crowded = handoff(_crowded(heads, found), "crowded")
        if crowded.isEmpty():
            break
        linked = confirmed[0]
        for more in confirmed[1:]:
            linked = linked.unionByName(more)
        more = handoff(_hub_pairs(crowded, linked, percent) if hubs else _deeper_pairs(crowded, percent), "more-pairs")
        if more.isEmpty():
            continue
        settle_all(more)
    of_class = handoff(classes.join(found, "node", "left")
                       .select("digest", F.coalesce("component", "node").alias("component_id")), "components")
    return (nodes.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
            .select(F.col("doc_id").alias(id_col), "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
