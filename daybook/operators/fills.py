"""Gap filling and imputation.

Forward / backward fill in order of a time column, optionally per key.

A single window ``last(c, ignorenulls) over (partition by key order by t)``
sorts each key inside one task, and with no key at all (the global fill of the
index closes) it moves the whole table into one partition.  We fill in two
phases instead:

1. split every key's timeline into buckets (month by default) and fill inside
   ``(key, bucket)`` windows -- many small, independent partitions;
2. take each bucket's edge value (last non-null for forward, first non-null
   for backward), carry it across buckets with a window over the small
   ``(key, bucket)`` table, and join it back on ``(key, bucket)``, which is the
   partitioning phase 1 already produced.

Rows that are still null inside their bucket take the carried value.  The
result equals the single-window fill; only the bucket table (keys x buckets)
is ordered as a whole.

Months are buckets of dates whose series have a bounded number of rows a day.
For any other order column, or where one month of one key may hold most of the
table, buckets are ranges of about equal numbers of rows
(:mod:`daybook.operators.scans`): no key and no stretch of time is one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from daybook.functions.dates import month_bucket
from daybook.functions.exact import exact_mean
from daybook.operators import scans

FORWARD = "forward"
BACKWARD = "backward"


def _has_months(df: DataFrame, order_col: str) -> bool:
    return isinstance(df.schema[order_col].dataType, (DateType, TimestampType, TimestampNTZType))


def fill_gaps(df: DataFrame, cols: Sequence[str], order_col: str,
              keys: Sequence[str] = (), direction: str = FORWARD,
              bucket: Column | None = None, method: str = "two_phase",
              materialize: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """Fill nulls of ``cols`` from the previous (forward) or next (backward)
    non-null value in ``order_col`` order, within ``keys``.

    ``bucket`` must be non-decreasing in ``order_col`` (default: the month of a
    date or timestamp, else ranges as in ``method="scan"``).
    ``method="scan"`` cuts the order into ranges of about equal numbers of
    rows, so a key that holds most rows of one month is split as well; it
    samples the input first.  ``ties`` are columns that order rows with equal
    ``order_col``.
    ``method="window"`` uses one window per key instead -- one shuffle, no
    join -- and is meant for tables whose groups are bounded by their grain
    (one row per day and region, say); it needs ``keys``, because without
    them the window would hold the whole table in one partition.

    The two-phase fill reads its input twice, and Spark prunes the columns of
    each read differently, so an expensive input would be computed twice;
    ``materialize=True`` first writes the input to the shared checkpoint
    folder (use it for small tables with a long lineage).
    """
    if direction not in (FORWARD, BACKWARD):
        raise ValueError(direction)
    keys = list(keys)
    if method == "window":
        if not keys:
            raise ValueError("method='window' needs keys; use the two-phase fill")
        if direction == FORWARD:
            w = Window.partitionBy(*keys).orderBy(order_col, *ties) \
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            fill = lambda c: F.last(c, ignorenulls=True).over(w)
        else:
            w = Window.partitionBy(*keys).orderBy(order_col, *ties) \
                .rowsBetween(Window.currentRow, Window.unboundedFollowing)
            fill = lambda c: F.first(c, ignorenulls=True).over(w)
        return df.select(*[fill(f.name).alias(f.name) if f.name in cols else F.col(f.name)
                           for f in df.schema.fields])
    if method not in ("two_phase", "scan"):
        raise ValueError(method)
    from daybook.sources.sinks import handoff
    if bucket is None and (method == "scan" or not _has_months(df, order_col)):
        source = handoff(df, "fill-input") if materialize else df
        base = source.withColumn("_bucket", scans.range_of(
            F.col(order_col), scans.range_cuts(source, order_col, scans.ranges_for(source))))
    else:
        base = df.withColumn("_bucket", month_bucket(order_col) if bucket is None else bucket)
        base = handoff(base, "fill-input") if materialize else base
    part = keys + ["_bucket"]

    whole = Window.partitionBy(*part).orderBy(order_col, *ties) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if direction == FORWARD:
        frame = Window.partitionBy(*part).orderBy(order_col, *ties) \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = [F.last(c, ignorenulls=True).over(frame).alias(f"_in_{c}") for c in cols]
        edge = [F.last(c, ignorenulls=True).over(whole).alias(f"_edge_{c}") for c in cols]
        carry_frame = Window.partitionBy(*keys).orderBy("_bucket") \
            .rowsBetween(Window.unboundedPreceding, -1)
        carry = [F.last(f"_edge_{c}", ignorenulls=True).over(carry_frame).alias(f"_carry_{c}")
                 for c in cols]
    else:
        frame = Window.partitionBy(*part).orderBy(order_col, *ties) \
            .rowsBetween(Window.currentRow, Window.unboundedFollowing)
        local = [F.first(c, ignorenulls=True).over(frame).alias(f"_in_{c}") for c in cols]
        edge = [F.first(c, ignorenulls=True).over(whole).alias(f"_edge_{c}") for c in cols]
        carry_frame = Window.partitionBy(*keys).orderBy("_bucket") \
            .rowsBetween(1, Window.unboundedFollowing)
        carry = [F.first(f"_edge_{c}", ignorenulls=True).over(carry_frame).alias(f"_carry_{c}")
                 for c in cols]

    # One exchange and sort of the data by (keys, bucket); the in-bucket fill
    # and each bucket's edge value come out of the same window operator.  The
    # per-bucket table is aggregated from that output without another
    # exchange, carried across buckets, and joined back on (keys, bucket).
    windowed = base.select("*", *local, *edge)
    edges = windowed.groupBy(*part).agg(*[F.max(f"_edge_{c}").alias(f"_edge_{c}") for c in cols])
    carried = edges.select(*part, *carry)
    # null-safe: a null key or a null order value has a bucket of its own
    carried = carried.select(*[F.col(c).alias(f"_of_{c}") for c in part],
                             *[f"_carry_{c}" for c in cols])
    joined = windowed.join(carried, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in part], "left")
    out_cols = []
    for f in df.schema.fields:
        if f.name in cols:
            out_cols.append(F.coalesce(F.col(f"_in_{f.name}"), F.col(f"_carry_{f.name}"))
                            .alias(f.name))
        else:
            out_cols.append(F.col(f.name))
    return joined.select(*out_cols)


def fill_forward(df, cols, order_col, keys=(), bucket=None, method="two_phase",
                 materialize=False, ties=()) -> DataFrame:
    """Carry the last seen value forward."""
    return fill_gaps(df, cols, order_col, keys, FORWARD, bucket, method, materialize, ties)


def fill_backward(df, cols, order_col, keys=(), bucket=None, method="two_phase",
                  materialize=False, ties=()) -> DataFrame:
    """Carry the next seen value backward."""
    return fill_gaps(df, cols, order_col, keys, BACKWARD, bucket, method, materialize, ties)


def fill_both(df, cols, order_col, keys=(), bucket=None, method="two_phase") -> DataFrame:
    """Forward, then backward for what is still missing (the intended D1 behaviour)."""
    return fill_backward(fill_forward(df, cols, order_col, keys, bucket, method),
                         cols, order_col, keys, bucket, method)


def impute_group_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                      method: str = "join", exact: bool = False) -> DataFrame:
    """J4 + A4 + F13: replace nulls by the mean of the column within the key.

    ``method="join"`` (default): means are a partial hash aggregate joined
    back on the key, so a hot key is combined map-side and its join can be
    split by AQE.  The input is evaluated twice (Spark prunes each branch's
    columns differently, so the branches rarely share exchanges).

    ``method="window"``: ``avg(c) over (partition by key)`` -- one pass and
    one shuffle; for tables whose groups are bounded by their grain (one row
    per day and region).

    ``exact`` (with ``join``): means whose bits don't depend on the order of rows.

    Rows with a null key get no fill, as in the reference's join.
    """
    keys = list(keys)
    if method == "window":
        w = Window.partitionBy(*keys)
        has_key = F.lit(True)
        for k in keys:
            has_key = has_key & F.col(k).isNotNull()
        return df.select(*[
            F.coalesce(F.col(f.name), F.when(has_key, F.avg(f.name).over(w))).alias(f.name)
            if f.name in cols else F.col(f.name) for f in df.schema.fields])
    if method != "join":
        raise ValueError(method)
    mean = exact_mean if exact else F.avg
    means = df.groupBy(*keys).agg(*[mean(c).alias(f"_mean_{c}") for c in cols])
    joined = df.join(means, keys, "left")
    return joined.select(*[
        F.coalesce(F.col(f.name), F.col(f"_mean_{f.name}")).alias(f.name) if f.name in cols
        else F.col(f.name) for f in df.schema.fields])
