"""Connected components of a link table by alternating large and small stars.

Every step is an aggregate and a join; no component of a large table is gathered
anywhere.  Steps are cut by written tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import handoff

MAX_STEPS = 60
#: Link tables of at most so many links (a few MB) are settled in one task; it
#: takes the same links and gives the same components as the star steps.
LOCAL_LINKS = 500_000


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and smallest node reachable, for a bounded number of links."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(root.setdefault(u, u)), find(root.setdefault(v, v))
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())],
                                     names=["node", "component"])


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
    return r[0], int(r[1])


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step.  Large: every node links its larger neighbours to the smallest
    node it sees; small: a node links itself and its smaller neighbours to it."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    if large:
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link; component: its smallest node.

    ``links`` has the integer columns ``a, b``; direction, repeats and loops
    don't matter.
    """
    edges = handoff(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links")
    state = _state(edges)
    if state[0] <= LOCAL_LINKS:
        return handoff(edges.repartition(1).mapInArrow(_union, "node bigint, component bigint"), "components")
    for _ in range(MAX_STEPS):
        if not state[0]:
            break
        # a large star makes no more rows than it reads: repeats may wait for the small one
        edges = handoff(_stars(_stars(edges, True), False).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
