"""Aggregations.

Null rules of the reference (pandas) that change results, applied here once:

* group keys that are null are dropped (pandas ``groupby`` drops them);
* a sum over only missing values is 0, not null;
* means skip missing values (same in both).

All aggregates are hash aggregates with a partial (map-side) phase, so a key
holding a large share of the rows costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from daybook.functions.exact import exact_mean
from daybook.functions.numbers import sum0


def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
              cast: str | None = "bigint") -> DataFrame:
    """Per-key sums; null keys dropped, all-null sums are 0."""
    aggs = []
    for m in measures:
        s = sum0(m)
        aggs.append((s.cast(cast) if cast else s).alias(m))
    return _non_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def group_mean(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
               names: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Per-key means; null keys dropped.  ``names`` renames outputs
    (for instance to Spark's ``avg(c)`` convention).  ``exact``: the same bits
    under any order and partitioning of the rows (:mod:`daybook.functions.exact`)."""
    names = list(names) if names else list(measures)
    mean = exact_mean if exact else F.avg
    return (_non_null_keys(df, keys).groupBy(*keys)
            .agg(*[mean(m).alias(n) for m, n in zip(measures, names)]))


def group_mean_exact(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A2 whose result does not depend on the order of rows: values are summed as
    decimals of ten places and divided by their count; null keys dropped.

    For means that are rounded afterwards: a plain double sum may land on
    either side of a tie from run to run.
    """
    exact = {m: F.col(m).cast("decimal(38,10)") for m in measures}
    return (_non_null_keys(df, keys).groupBy(*keys)
            .agg(*[F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(m) for m, c in exact.items()]))


def mixed_rollup(df: DataFrame, keys: Sequence[str], sums: Sequence[str],
                 means: Sequence[str], sum_cast: str | None = "bigint") -> DataFrame:
    """A5: several sums and several means by the same keys, one aggregate."""
    aggs = [(sum0(c).cast(sum_cast) if sum_cast else sum0(c)).alias(c) for c in sums]
    aggs += [F.avg(c).alias(c) for c in means]
    return _non_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def pivot_mean(df: DataFrame, keys: Sequence[str], pivot_col: str, value_col: str,
               values: Sequence[str], exact: bool = False) -> DataFrame:
    """A3: mean of ``value_col`` per key, one column per listed pivot value.

    Written as conditional aggregation (``avg(case when ...)``), one hash
    aggregate with a partial phase.  Semantics of a pandas pivot table:
    null values are ignored, so a key whose values are all null has no row;
    a key seen only with an unlisted pivot value keeps an all-null row.

    ``exact`` gives the same bits under any order of the rows; the parts of the
    sums are then kept per pivot value, in long form, and spread afterwards.
    """
    base = _non_null_keys(df.where(F.col(value_col).isNotNull()), keys)
    if exact:
        means = base.groupBy(*keys, pivot_col).agg(exact_mean(value_col).alias("_mean"))
        return means.groupBy(*keys).agg(*[F.max(F.when(F.col(pivot_col) == F.lit(v), F.col("_mean"))).alias(v)
                                          for v in values])
    aggs = [F.avg(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(v)
            for v in values]
    return base.groupBy(*keys).agg(*aggs)


def arg_extremes(totals: DataFrame, key: str, value: str) -> DataFrame:
    """Key with the largest and with the smallest ``value``, with the values.

    Ties go to the first key in sort order, for both ends.  ``min`` over a
    struct compares field by field, so ``min(struct(-v, k))`` is the largest
    ``v`` with the smallest ``k``; it aggregates partially like any ``min``.
    """
    rows = totals.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    hi = F.min(F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    lo = F.min(F.struct(F.col(value).alias("v"), F.col(key).alias("k")))
    return (rows.agg(hi.alias("_hi"), lo.alias("_lo"))
            .select(F.col("_hi.k").alias(f"max_{key}"), (-F.col("_hi.v")).alias(f"max_{value}"),
                    F.col("_lo.k").alias(f"min_{key}"), F.col("_lo.v").alias(f"min_{value}")))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample standard deviation, min, max of one column."""
    c = F.col(column)
    return df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def time_range(df: DataFrame, column: str) -> DataFrame:
    """Global first and last timestamp."""
    return df.agg(F.min(column).alias("first_ts"), F.max(column).alias("last_ts"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type and non-null count.

    One aggregate over the table, then a ``stack`` of the per-column counts;
    the type names come from the schema (no data access).
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])

    def lit(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(
        f"{lit(f.name)}, {lit(f.dataType.simpleString())}, c{i}" for i, f in enumerate(fields))
    return counts.selectExpr(
        f"stack({len(fields)}, {pairs}) as (column_name, data_type, non_null)")


#: Stated errors of the sketches of :func:`table_summary`: the number of distinct values
#: (relative), and the rank of a quartile (share of the rows).
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.01


def table_summary(df: DataFrame, sketches: bool = True) -> DataFrame:
    """A9/A10/A12 over all columns of any types, in one pass: one row per column.

    ``column_name, data_type, n_rows, non_null``; ``mean, stddev, min_number,
    max_number`` of numbers; ``min_text, max_text`` of texts, days, timestamps and
    booleans (as text).  With ``sketches`` also ``distinct_about`` (mergeable
    sketch, within ``DISTINCT_ERROR`` of the true number with three standard
    errors) and, of numbers, days and timestamps, ``q25, q50, q75``: values
    whose rank is within ``RANK_ERROR`` of the quartile's (days and timestamps
    as seconds since 1970).  Nested columns get counts only.

    All columns come out of one aggregate with a partial phase, whatever their number.
    """
    numbers = (NumericType,)
    plain = (StringType, DateType, TimestampType, TimestampNTZType, BooleanType)
    accuracy = int(1 / RANK_ERROR) * 4
    rows = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        number = c.cast("double") if isinstance(kind, numbers) else None
        text = c if isinstance(kind, plain) else None
        seconds = (F.unix_seconds(c.cast("timestamp")).cast("double")
                   if isinstance(kind, (DateType, TimestampType, TimestampNTZType)) else None)

        def of(x, fn, cast):
            return (fn(x) if x is not None else F.lit(None)).cast(cast)
        cells = [F.lit(f.name).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"),
                 F.count(F.lit(1)).alias("n_rows"), F.count(c).alias("non_null"),
                 of(number, exact_mean, "double").alias("mean"), of(number, F.stddev_samp, "double").alias("stddev"),
                 of(number, F.min, "double").alias("min_number"), of(number, F.max, "double").alias("max_number"),
                 of(text, F.min, "string").alias("min_text"), of(text, F.max, "string").alias("max_text")]
        if sketches:
            nested = not isinstance(kind, numbers + plain)
            cells.append(of(None if nested else c, lambda x: F.approx_count_distinct(x, DISTINCT_ERROR / 3),
                            "bigint").alias("distinct_about"))
            place = number if number is not None else seconds
            cells += [of(place, lambda x, q=q: F.percentile_approx(x, q / 100, accuracy), "double").alias(f"q{q}")
                      for q in (25, 50, 75)]
        rows.append(F.struct(*cells))
    return df.agg(F.array(*rows).alias("_rows")).select(F.explode("_rows").alias("_r")).select("_r.*")


def mean_per_x(df: DataFrame, x: str, ys: Sequence[str], exact: bool = False) -> DataFrame:
    """Mean of each ``y`` per ``x`` (what a line chart draws when x repeats)."""
    return group_mean(df, [x], ys, exact=exact)


def total_of(df: DataFrame, keys: Sequence[str], exprs: Sequence[Column]) -> DataFrame:
    """Free-form grouped aggregate with the null-key rule applied."""
    return _non_null_keys(df, keys).groupBy(*keys).agg(*exprs)
