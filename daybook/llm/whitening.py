"""Whitening of embeddings by singular values, without forming a covariance matrix.

1. Rows with a null vector, or with null or non-finite entries, are dropped; each
   entry c becomes the integer ``floor(64 c) + 1000000``.  The fit list holds
   each distinct vector once (a partial aggregate, so copies meet in their
   task first) and is written once.
2. n and the sums per dimension are exact integers.
3. Blockwise QR: every task centres its rows, exactly as ``(n x - S) / n``, and
   keeps only the triangle R of them; triangles are stacked and reduced again,
   a bounded number at a time.  One triangle, as wide as the vectors, is left.
4. On it: Householder bidiagonalisation, dqds for the singular values, twisted
   factorisations for the directions (:mod:`daybook.llm.bidiagonal`).
5. Every kept row is centred, projected and divided by the root of the variance.
   The error against the identity is measured over the fit list.

The width is that of the most rows (the greater of two as frequent); rows of
other widths take no part, nor do empty vectors.  Entries beyond 2^52 / 64 count
as that bound.  Components without variance (a constant dimension, fewer
distinct vectors than components, a single row) have a null ``whitened``; their
``explained`` is 0, or null where no dimension varies.  ``deviation`` is null
beyond 64 bits.  Repeated or null ids keep a row each; other columns are
ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.bidiagonal import EPS, singular
from daybook.llm.common import handoff, slices

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BOUND = 1 << 52
#: Triangles stacked at a time.
STACK = 16
BLOCK_ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` and ``sums`` of the fit list, unit ``directions``
    (one a row) with their ``variances``, the ``trace`` of the covariance and
    the measured ``identity_error``."""

    width: int
    n: int
    sums: tuple[int, ...]
    variances: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float = 0.0

    def living(self) -> np.ndarray:
        """Components whose variance is not lost in the rounding of the greatest."""
        least = self.width * EPS * max(self.variances[0], 0.0) if len(self.variances) else 0.0
        return self.variances > least


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x``: ids and integer vectors of the rows that take part, of any width."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = rows.where((F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))

    def integer(c):
        c = F.greatest(F.least(c * SCALE, F.lit(float(BOUND))), F.lit(float(-BOUND)))
        return F.floor(c).cast("bigint") + SHIFT
    return whole.select("id", F.transform(v, integer).alias("x"))


def width_of(rows: DataFrame) -> int | None:
    """The width that most rows have."""
    first = (rows.groupBy(F.size("x").alias("width")).count()
             .orderBy(F.desc("count"), F.desc("width")).first())
    return None if first is None else first["width"]


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n x - S``, exact: 64-bit integers where they are sure to fit, else Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sums(width: int):
    """Per task and dimension, the sum of the entries in two exact halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for part in slices(batches, BLOCK_ROWS):
            x = _matrix(part, width)
            high = (x >> 26).sum(0).tolist()
            low = (x & ((1 << 26) - 1)).sum(0).tolist()
            total = [t + (h << 26) + a for t, h, a in zip(total, high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([str(t) for t in total], pa.string())], names=["at", "total"])
    return run


def _triangle(rows: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(rows), mode="r")


def _triangles(width: int, n: int, sums: tuple[int, ...]):
    """One triangle a task: its centred rows, block after block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for part in slices(batches, BLOCK_ROWS):
            block = _centred(_matrix(part, width), n, sums).astype(float) / n
            r = _triangle([block] if r is None else [r, block])
        rows = [] if r is None else [r.astype("<f8").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["r"])
    return run


def _stacked(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column(0).to_pylist():
                parts = sorted(group, key=lambda p: p["at"])
                r = _triangle([np.frombuffer(p["r"], "<f8").reshape(-1, width) for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])
    return run


def triangle(fit_rows: DataFrame, width: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """R of the centred fit list.  Triangles meet ``STACK`` at a time, in as many
    rounds as that takes; the last few come to the driver."""
    rows = handoff(fit_rows.mapInArrow(_triangles(width, n, sums), "r binary")
                   .withColumn("at", F.monotonically_increasing_id()), "triangles")
    count = rows.count()
    while count > STACK:
        # the rank of a triangle decides its group: by task, then within it
        parts = rows.select("r", "at", F.pmod(F.hash("at"), F.lit(math.ceil(count / STACK))).alias("g"))
        grouped = parts.groupBy("g").agg(F.collect_list(F.struct("at", "r")).alias("group"))
        rows = handoff(grouped.select("group").mapInArrow(_stacked(width), "r binary")
                       .withColumn("at", F.monotonically_increasing_id()), "triangles")
        count, before = rows.count(), count
        if count >= before:
            break
    last = rows.orderBy("at").collect()        # at most STACK triangles of the vectors' width
    return _triangle([np.frombuffer(p["r"], "<f8").reshape(-1, width) for p in last])


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened components of integer vectors; NaN where there is no variance."""
    centred = _centred(x, model.n, model.sums).astype(float) / model.n
    out = centred @ model.directions.T
    living = model.living()
    out[:, living] /= np.sqrt(model.variances[living])
    out[:, ~living] = np.nan
    return out


def _moments(model: Whitening):
    """Per task, the sums and products of whitened components over the fit list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = int(model.living().sum())
        total = np.zeros((k + 1, k))
        for part in slices(batches, BLOCK_ROWS):
            w = _project(_matrix(part, model.width), model)[:, model.living()]
            total += np.vstack([w.sum(0), w.T @ w])
        i, j = np.divmod(np.arange(total.size), max(k, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel(), pa.float64())],
            names=["i", "j", "total"])
    return run


def _identity_error(fit_rows: DataFrame, model: Whitening) -> float:
    k = int(model.living().sum())
    if not k:
        return 0.0
    total = np.zeros((k + 1, k))
    for r in (fit_rows.mapInArrow(_moments(model), "i int, j int, total double")
              .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()):   # (k + 1) * k rows
        total[r["i"], r["j"]] = r["total"]
    mean = total[0] / model.n
    return float(np.abs(total[1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def fit(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Fit on the distinct vectors of ``rows`` (see :func:`integers`)."""
    fit_rows = handoff(rows.where(F.size("x") == width).select("x").distinct(), "fit-list")
    n = fit_rows.count()
    totals = (fit_rows.mapInArrow(_sums(width), "at int, total string")
              .groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    sums = tuple(int(r["total"]) for r in sorted(totals, key=lambda r: r["at"]))
    r = triangle(fit_rows, width, n, sums)
    squares, directions = singular(r, min(components, width))
    model = Whitening(width, n, sums, squares[:len(directions)] / n, directions, float((r * r).sum()) / n)
    return Whitening(width, n, sums, model.variances, directions, model.trace, _identity_error(fit_rows, model))


def _whitened(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        explained = [None if not model.trace else float(v) / model.trace if alive else 0.0
                     for v, alive in zip(model.variances, model.living())]
        for part in slices(batches):
            x = _matrix(part, model.width)
            gap = _centred(x, model.n, model.sums)
            if gap.dtype != object and int(np.abs(gap).max(initial=0)) ** 2 * model.width >= 1 << 63:
                gap = gap.astype(object)
            deviation = [None if d >= 1 << 63 else d for d in (gap * gap).sum(1).tolist()]
            w = _project(x, model).ravel()
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i in part.column(0).to_pylist() for _ in range(k)], pa.int64()),
                 pa.array(list(range(1, k + 1)) * m, pa.int32()), pa.array([model.n] * (m * k), pa.int64()),
                 pa.array([d for d in deviation for _ in range(k)], pa.int64()),
                 pa.array(w, pa.float64(), mask=np.isnan(w)), pa.array(explained * m, pa.float64()),
                 pa.array([model.identity_error] * (m * k), pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


_OUT = ("id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double")


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``id`` and one row a component for every vector of the model's width."""
    return rows.where(F.size("x") == model.width).mapInArrow(_whitened(model), _OUT)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Fit and transform: ``id_col, component, n, deviation, whitened, explained,
    identity_error`` of every row that takes part."""
    rows = integers(vectors, id_col, vector_col)
    width = width_of(rows)
    if width is None:
        out = vectors.sparkSession.createDataFrame([], _OUT)
    else:
        out = transform(rows, fit(rows, width, components))
    return out.withColumnRenamed("id", id_col)
