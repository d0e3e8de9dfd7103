"""Approximate nearest neighbours by collision counting.

For the largest inner product, vectors get one more component that makes all
lengths equal, and queries are normalised: then the nearest vector is the one
with the largest inner product.  Each block of vectors is indexed by
single random projections (the axes of random rotations), each kept as a sorted array.  A query opens a
window around its own place in every array.  Windows widen together (virtual
rehashing: nothing is hashed again) until enough vectors collide with the
query in at least a share ``THRESHOLD`` of the arrays.  All of those are verified with
their exact inner product, and the nearest are merged over the blocks.

Every vector is indexed.  Blocks of vectors meet chunks of queries in tasks of
bounded size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURNS = 1                 # random rotations; each gives as many orthogonal projections as dimensions
THRESHOLD = 0.85          # of the arrays
FIRST_WIDTH = 0.5         # half a window, in units of the vectors' common length
GROWTH = 1.2
VERIFY_SHARE = 0.1        # of a block: fewer vectors over the threshold (plus k) widen the windows
BLOCK = 8192
CHUNK = 2048


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, inner product) of the ``k`` nearest found for each query, its own id left out."""
    n, dim = vectors.shape
    length = np.sqrt((vectors * vectors).sum(axis=1))
    most = length.max()
    rng = np.random.default_rng(10)
    turns = [np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0] * np.sqrt(dim + 1)
             for _ in range(TURNS)]
    rays = np.concatenate(turns)
    allowed = int((1 - THRESHOLD) * len(rays))               # arrays in which a vector may be missed
    tail = np.sqrt(np.maximum(0.0, 1 - (length / most) ** 2))
    places = rays[:, :dim] @ (vectors / most).T + rays[:, dim:] * tail
    order = np.argsort(places, axis=1, kind="stable").astype(np.int32)
    arrays = np.take_along_axis(places, order, axis=1)
    own = rays[:, :dim] @ (queries / np.sqrt((queries * queries).sum(axis=1))[:, None]).T
    need = min(n, k + 1 + int(np.ceil(VERIFY_SHARE * n)))
    out_q, out_v, out_s = [], [], []
    start = FIRST_WIDTH
    for i in range(len(queries)):
        width = start
        while True:
            lo = [a.searchsorted(p - width) for a, p in zip(arrays, own[:, i])]
            hi = [a.searchsorted(p + width, side="right") for a, p in zip(arrays, own[:, i])]
            # windows are wide: what lies outside them is the shorter list to tally
            missed = np.concatenate([p for o, x, y in zip(order, lo, hi) for p in (o[:x], o[y:])])
            found = np.flatnonzero(np.bincount(missed, minlength=n) <= allowed)
            if len(found) >= need:
                break
            width *= GROWTH
        start = max(FIRST_WIDTH, width / GROWTH)          # the next query begins near
        found = found[ids[found] != query_ids[i]]
        score = vectors[found] @ queries[i]
        best = np.lexsort((ids[found], -score))[:k]
        out_q.append(np.full(len(best), query_ids[i]))
        out_v.append(ids[found][best])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _block(k: int):
    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        left = left.sort_values("vec_id")
        q, v, s = search(np.stack(left["vec"].to_numpy()).astype(np.float64), left["vec_id"].to_numpy(),
                         np.stack(right["vec"].to_numpy()).astype(np.float64), right["vec_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})
    return block


def nearest(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, ties to the smaller id.

    ``queries`` is a condition on the id column that picks the queries.  Null
    vectors or ids, empty and zero vectors, and vectors with a null or
    non-finite component take no part.  Of rows with equal ids the greatest
    vector counts.  Vectors are compared with queries of their own dimension.
    """
    vec = F.col(vector_col).cast("array<double>")
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec"))
            .where("vec_id IS NOT NULL AND vec IS NOT NULL")
            .where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .where(F.exists("vec", lambda x: x != 0)))
    rows = rows.groupBy("vec_id").agg(F.max("vec").alias("vec")).withColumn("dim", F.size("vec"))
    asked = rows.where(queries(F.col("vec_id")))
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(queries(F.col("vec_id")), 1)).alias("q")).first()
    blocks, chunks = max(1, -(-n["n"] // BLOCK)), max(1, -(-n["q"] // CHUNK))
    key = ["dim", "block", "chunk"]
    data = (rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    ask = (asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
           .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))))
    found = (data.groupBy(*key).cogroup(ask.groupBy(*key))
             .applyInPandas(_block(k), "query_id bigint, vec_id bigint, score double"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
