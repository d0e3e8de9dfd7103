"""Sinks.

Writes keep the upstream partitioning: one output file per task.  A single
file is opt-in and uses ``repartition(1)``, which adds one exchange but keeps
everything before it parallel (``coalesce(1)`` would pull the whole last stage
into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False,
              partition_by: list[str] | None = None) -> None:
    """K1/K2: delimited text with a header, overwriting ``path``."""
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True).option("sep", sep)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Columnar hand-off for stage outputs that several consumers read."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_table(df: DataFrame, name: str, path: str, partition_by: str) -> None:
    """A lasting table of the session catalog (``db.table``), partitioned, its files in
    ``path``; the database is created next to them where it doesn't exist."""
    database, _, _ = name.rpartition(".")
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{path}.db'")
    # adaptive execution gathers a partition's rows in few files and splits large ones
    (df.hint("rebalance", partition_by).write.mode("overwrite").option("path", path)
     .partitionBy(partition_by).saveAsTable(name))


def day_digests(df: DataFrame, day_col: str) -> DataFrame:
    """Per day the number of rows and an order-independent digest of them."""
    both = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.groupBy(F.col(day_col).cast("string").alias("_day")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(both.cast("decimal(38,0)")).alias("_digest"),
        F.bit_xor(F.xxhash64(both, F.lit(1))).alias("_mixed"))


def _without(a: DataFrame, b: DataFrame, cols) -> DataFrame:
    """Rows of ``a`` that have no equal in ``b`` (nulls are equal)."""
    other = b.select(*[F.col(c).alias(f"{c}_b") for c in cols])
    equal = [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in cols]
    return a.join(other, equal, "left_anti")


def write_days(df: DataFrame, path: str, day_col: str) -> list[str | None]:
    """K1 by day: bring the Parquet table at ``path``, partitioned by day, up to ``df``.

    Only days whose rows differ from what is there are written (dynamic
    partition overwrite), so a new report day rewrites its own day and those
    that its figures change (a gap filled from it, a mean it shifts); files of
    all other days stay as they are.  A day that ``df`` no longer has is left
    without rows.  Returns the days written, in order.

    ``df`` is handed over once; days are compared by digests (a row a day).
    """
    spark = df.sparkSession
    df = handoff(df.withColumn("_day", F.col(day_col).cast("string")), "days")
    new = day_digests(df.drop("_day"), day_col)
    if path_exists(spark, path):
        kept = spark.read.schema(df.schema).parquet(path).select(*[c for c in df.columns if c != "_day"])
        old = handoff(day_digests(kept, day_col), "old-days")
        changed = handoff(_without(new, old, ("_day", "_rows", "_digest", "_mixed")), "changed")
        gone = [r["_day"] for r in _without(old, new, ("_day",)).collect()]
    else:
        changed, gone = handoff(new, "changed"), []
    days = sorted((r["_day"] for r in changed.select("_day").collect()), key=lambda d: (d is not None, d))
    if days:
        part = df.join(F.broadcast(changed.select(F.col("_day").alias("_changed"))),
                       F.col("_day").eqNullSafe(F.col("_changed")), "left_semi")
        (part.hint("rebalance", "_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_day").parquet(path))
    for day in gone:
        name = "__HIVE_DEFAULT_PARTITION__" if day is None else day
        old_part = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_day={name}")
        old_part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old_part, True)
    return days


def path_exists(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_days(spark, path: str, schema=None) -> DataFrame:
    """A table written by :func:`write_days`.  Of a table that never had a day nothing is
    there: given its ``schema``, it reads as empty."""
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).drop("_day")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """K3: the first ``n`` rows (a plan, not a driver-side print)."""
    return df.limit(n)


def handoff(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage where a table is consumed more than once (Spark would
    otherwise recompute everything above the last shared exchange for each
    consumer) and survives executor loss, unlike a cache.  Runs one job now.
    """
    from daybook.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_parquet(df, path)
    return spark.read.parquet(path)


def render_dates(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Render every ``date`` column as text (the deliverables' day format).

    Days stay ``DateType`` inside the plans (joins, windows, buckets); at the
    edge they become ``yyyy-MM-dd`` text, the form the reference's own
    outputs carry, readable the same way by any consumer.
    """
    from pyspark.sql.types import DateType
    if not any(isinstance(f.dataType, DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.date_format(f.name, fmt).alias(f.name)
                       if isinstance(f.dataType, DateType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
