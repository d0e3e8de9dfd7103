"""Prefix scans over an ordered table: ranges, global ranks, carried values.

An order over a whole table (or over one key that holds most of it) is a scan:
cut the order into ranges of about equal numbers of rows, work inside each
range, carry one row per range across.  The cuts come from a uniform sample of
rows of a bounded size; they decide only how even the ranges are, never the
result.  Every orderable type works (numbers, text, dates, timestamps).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows wanted in a range, and the most ranges of a table.
RANGE_ROWS = 1_000_000
MAX_RANGES = 4096
#: Sampled rows for each range.
SAMPLE_FACTOR = 16
#: Cuts looked at together in one step of the search for a row's range.
FANOUT = 64


def range_cuts(df: DataFrame, order_col: str, ranges: int) -> list:
    """At most ``ranges - 1`` different values that cut ``order_col`` into ranges of
    about equal numbers of rows.

    The sample is the rows with the smallest hash of (value, row position):
    each task keeps at most the sample's size, so does the driver.
    """
    if ranges < 2:
        return []
    size = ranges * SAMPLE_FACTOR
    sample = (df.select(F.col(order_col).alias("v")).where(F.col("v").isNotNull())
              .withColumn("h", F.xxhash64("v", F.monotonically_increasing_id()))
              .orderBy("h").limit(size).orderBy("v").select("v"))
    values = [r["v"] for r in sample.collect()]
    picked = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
    return [v for i, v in enumerate(picked) if i == 0 or v != picked[i - 1]]


def range_of(order: Column, cuts: Sequence) -> Column:
    """Number of the range that holds ``order``: how many cuts are not above it.

    Found in steps of at most ``FANOUT`` comparisons: first among every 64th
    cut, then among those that follow it.  Null for a null.
    """
    if not cuts:
        return F.when(order.isNotNull(), F.lit(0))
    every = F.array(*[F.lit(c) for c in cuts])
    if len(cuts) <= FANOUT:
        return F.when(order.isNotNull(), F.size(F.filter(every, lambda c: c <= order)))
    firsts = F.array(*[F.lit(c) for c in cuts[::FANOUT]])
    group = F.size(F.filter(firsts, lambda c: c <= order))       # groups that begin at or before it
    inside = F.size(F.filter(F.slice(every, F.greatest(group - 1, F.lit(0)) * FANOUT + 1, FANOUT),
                             lambda c: c <= order))
    return F.when(order.isNotNull(), F.greatest(group - 1, F.lit(0)) * FANOUT + inside)


def ranges_for(df: DataFrame, range_rows: int = RANGE_ROWS) -> int:
    """How many ranges a table gets: as many as it has ``range_rows``, within
    ``MAX_RANGES``, and as many as the session has shuffle partitions at least
    where there are rows enough to share."""
    n = df.count()
    least = min(n // 1000, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(MAX_RANGES, max(-(-n // range_rows), least)))


def with_global_rank(df: DataFrame, order_col: str, name: str = "rank", start: int = 0,
                     ties: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Position of every row in the order of ``order_col`` (then ``ties``), nulls first,
    counting from ``start``, without one task that holds all rows.

    Rows are numbered inside their range; the counts of the ranges (a table of
    as many rows as ranges) add up to each range's offset.  ``df`` is read
    three times: hand over a written table if it is dear.
    """
    ranges = ranges_for(df) if ranges is None else ranges
    cuts = range_cuts(df, order_col, ranges)
    part = F.coalesce(range_of(F.col(order_col), cuts), F.lit(-1))
    counts = {r["_range"]: r["count"] for r in
              df.select(part.alias("_range")).groupBy("_range").count().collect()}     # one row a range
    offsets, total = [], start
    for i in range(-1, len(cuts) + 1):
        offsets.append(total)
        total += counts.get(i, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("_range") + 2)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order_col, *ties)) - 1
    return (df.withColumn("_range", part).withColumn(name, (inside + offset).cast("bigint"))
            .drop("_range"))


def range_of_value(value, cuts: Sequence) -> int:
    """:func:`range_of` for one Python value."""
    return bisect_right(list(cuts), value)
