"""Joins.

Physical strategy is left to Catalyst and adaptive execution.  The one place
we steer it is broadcasting a lookup table, and only after proving its size:
:func:`bounded_broadcast` counts at most ``max_rows + 1`` rows of the small
side and falls back to a shuffled join when the bound does not hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

#: Default bounds, in rows and in bytes, for lookup tables we are willing to ship to every task.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: A key with this share of the rows is hot, and how many keys a sketch follows.
HOT_SHARE = 0.01
TRACKED_KEYS = 10_000


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 8 for a number or a day, the length of a text, the length
    of the JSON text of anything nested."""
    def of(f) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        return F.lit(8)
    return reduce(lambda a, b: a + b, [of(f) for f in df.schema.fields], F.lit(8))


def is_bounded(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows of together at most ``max_bytes``.

    Looks at ``limit(max_rows + 1)`` rows, which stops reading once the bound
    is exceeded, so it is cheap whether or not the table is small.
    """
    rows, size = df.select(row_bytes(df).alias("b")).limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold about ``share`` of the rows or more: at most ``1 / share`` values.

    One pass with a mergeable sketch of the most frequent keys; a key it takes
    for hot by mistake only costs a little more work.
    """
    n, top = df.select(F.col(key).alias("k")).agg(
        F.count("k"), F.expr(f"approx_top_k(k, {int(1 / share)}, {TRACKED_KEYS})")).first()
    return [] if not n else [r["item"] for r in top if r["item"] is not None and r["count"] >= share * n]


def skew_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left",
              share: float = HOT_SHARE, salts: int | None = None) -> DataFrame:
    """Shuffled equi-join (``left`` or ``inner``) in which no hot key of ``facts`` is one task.

    The rows of hot keys are dealt over ``salts`` parts (default: the session's
    shuffle partitions) by their content and their task; the dimension rows of
    these keys, and of no others, are repeated for every part.  Facts without a
    key match nothing and are dealt as well.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    salts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, fact_key, share)
    k = F.col(f"`{fact_key}`")
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]) + F.spark_partition_id(), F.lit(salts))
    is_hot = (k.isin(*hot) if hot else F.lit(False)) | k.isNull()
    left = facts.withColumn("_salt", F.when(is_hot, dealt).otherwise(F.lit(0)).cast("int"))
    parts = F.array(F.lit(0))
    if hot:
        parts = F.when(F.col(f"`{dim_key}`").isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(parts)
    right = dim.withColumn("_dim_salt", F.explode(parts))
    return (left.join(right, (left[fact_key] == right[dim_key]) & (F.col("_salt") == F.col("_dim_salt")), how)
            .drop("_salt", "_dim_salt"))


def ambiguous_keys(dim: DataFrame, key: str, value: str) -> DataFrame:
    """Keys listed with more than one value (decision D5: each of them is joined), with
    the values in order: ``key, n_values, values``."""
    return (dim.where(F.col(key).isNotNull()).select(key, value).distinct().groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_values"), F.array_sort(F.collect_list(value)).alias("values"))
            .where(F.col("n_values") > 1))


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      bound_from: DataFrame | None = None) -> DataFrame:
    """Broadcast-hint ``df`` if it is within the bounds (rows and bytes), else return it as is.

    ``bound_from`` may name a table with at least as many rows as ``df`` (its
    input before de-duplication, say) whose count is cheaper to check.
    Without the hint Spark still broadcasts small sides on its own statistics
    and adaptive execution can convert a shuffled join at runtime.
    """
    return F.broadcast(df) if is_bounded(bound_from if bound_from is not None else df,
                                         max_rows) else df


def unique_lookup(dim: DataFrame, key: str, value_cols: Sequence[str],
                  order_col: str | None = None) -> DataFrame:
    """Make a lookup table unique on ``key`` so joining it never fans out.

    A Python dict built from rows keeps one value per key; here the kept row
    is the one with the greatest ``order_col`` (or the greatest value when no
    order is given), which is deterministic.
    """
    if order_col is None:
        packed = F.max(F.struct(*[F.col(c) for c in value_cols]))
    else:
        packed = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order_col))
    return (dim.where(F.col(key).isNotNull())
            .groupBy(key).agg(packed.alias("_v"))
            .select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols]))


def lookup_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                value_cols: Sequence[str], max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left lookup ``fact_key -> value_cols``; unmatched facts keep null values."""
    lookup = unique_lookup(dim, dim_key, value_cols)
    # the raw dimension bounds its de-duplicated form and is cheaper to count
    if dim_key == fact_key:
        return facts.join(bounded_broadcast(lookup, max_rows, bound_from=dim), fact_key, "left")
    lookup = lookup.withColumnRenamed(dim_key, "_lookup_key")
    return (facts.join(bounded_broadcast(lookup, max_rows, bound_from=dim),
                       F.col(fact_key) == F.col("_lookup_key"), "left")
            .drop("_lookup_key"))


def fanout_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left join on ``fact_key = dim_key``; repeated dimension keys fan a
    fact row out, facts without a match keep null dimension columns.

    * small dimension: broadcast it (the usual case: a city list);
    * small facts, large dimension: a left join can only broadcast its right
      side, so it would shuffle the large dimension by a key with as few
      values as there are facts (a few hot partitions).  Instead: an inner
      join broadcasting the facts, plus the facts without a match, found by
      an anti join against the matched keys (at most as many as the facts);
    * both large: a shuffled left join that deals out hot keys (:func:`skew_join`).
    """
    if is_bounded(dim, max_rows):
        return facts.join(F.broadcast(dim), F.col(fact_key) == dim[dim_key], "left")
    if is_bounded(facts, max_rows):
        matched = dim.join(F.broadcast(facts), F.col(fact_key) == dim[dim_key], "inner")
        keys = (matched.select(F.col(fact_key).alias("_matched_key")).distinct())
        unmatched = facts.join(F.broadcast(keys), F.col(fact_key) == F.col("_matched_key"),
                               "left_anti")
        return matched.select(*facts.columns, *dim.columns).unionByName(
            unmatched, allowMissingColumns=True)
    return skew_join(facts, dim, fact_key, dim_key)


def join_keys_renamed(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      how: str = "left") -> DataFrame:
    """Join on differently named keys and drop the right key."""
    return left.join(right, F.col(left_key) == right[right_key], how).drop(right[right_key])


def align_series(series: Sequence[DataFrame], key: str) -> DataFrame:
    """Chain of left joins on one key: the first series decides the rows.

    Each series is one row per key (a daily aggregate), so the chain is a
    sequence of joins over small tables keyed identically; Spark reuses the
    key partitioning down the chain.
    """
    return reduce(lambda a, b: a.join(b, key, "left"), series)


def small_derived_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """A small table derived from big data (per-document statistics, say),
    ready to be joined back to that data.

    The table is computed once and written as Parquet under the shared
    checkpoint folder (one job; executor loss cannot lose it and the join
    does not recompute it), read back, and broadcast if its row count is
    within ``max_rows``.  Beyond the bound it stays a regular table and Spark
    plans a shuffled join.
    """
    from daybook.sources.sinks import handoff
    return bounded_broadcast(handoff(df, "derived"), max_rows)
