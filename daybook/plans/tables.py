"""Driver test tables mapped onto the roles of the reference's datasets.

Roles (FIXTURES.md §3): cases -> ``orders`` + ``customer``; region codes ->
``nation``; report cells -> built from ``lineitem``; air quality -> ``events``;
station -> region list -> ``supplier``; index closes -> per-status daily series
of ``orders``.  Each adapter only selects, renames and derives columns, so
Catalyst prunes the Parquet scans to the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.joins import BROADCAST_MAX_ROWS, bounded_broadcast
from daybook.sources.readers import read_table


_OPENED: dict[tuple[int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table.  The files are read-only, so one DataFrame per
    session and path is reused (file listing and footer reads happen once,
    not once per adapter that needs the table)."""
    key = (id(spark), sf_dir, name)
    df = _OPENED.get(key)
    if df is None or df.sparkSession is not spark:
        df = _OPENED[key] = read_table(spark, sf_dir, name)
    return df


_SMALL: dict[tuple, DataFrame] = {}


def small_table(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...],
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Columns of a driver test table, broadcast-hinted when the table has at
    most ``max_rows`` rows.  The files are read-only, so the size check runs
    once per session and table."""
    key = (id(spark), sf_dir, name, columns, max_rows)
    df = _SMALL.get(key)
    if df is None or df.sparkSession is not spark:
        df = _SMALL[key] = bounded_broadcast(table(spark, sf_dir, name).select(*columns),
                                             max_rows)
    return df


def region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region code table in the reference's column layout, from ``nation``."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.lit("state").alias("Subdivision category"),
        F.concat(F.lit("IN-N"), F.col("n_nationkey").cast("string")).alias("3166-2 code"),
        F.col("n_name").alias("Subdivision name"))


def case_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily case records: one per (order day, customer nation code).

    ``confirmed`` = whole order value, ``cured`` = orders with status O,
    ``death`` = orders with status F.  Orders meet the customer -> nation map
    first (broadcast when Spark sees it is small, else one shuffle of both by
    customer) and are then aggregated by (day, nation): the partial aggregate
    shrinks every task's output to days x nations before the only other
    shuffle.  (A per-(customer, day) pre-aggregate would barely reduce rows
    and would need a second shuffle by customer for the join.)
    """
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return (joined.groupBy("day", "c_nationkey")
            .agg(F.sum(F.floor("o_totalprice")).cast("bigint").alias("confirmed"),
                 F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("cured"),
                 F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("death"))
            .select(F.col("day").cast("string").alias("report_time"),
                    F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("state"),
                    "cured", "death", "confirmed"))


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality readings: station = user, pollutant = event type."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("location"),
        F.col("user_id").alias("station_id"),
        F.lit("IN").alias("country"),
        F.col("event_type").alias("pollutant"),
        F.col("value"),
        F.col("ts").alias("timestamp"))


def closes_series(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Five daily "index close" series: mean order value per day for each
    order status and for urgent orders, with ``Date`` rendered ``dd MMM yyyy``
    like the index exports.  Values are sums of cents over counts, so that a
    close has the same bits in every run."""
    o = table(spark, sf_dir, "orders")
    specs = [
        ("close_nifty_50", F.col("o_orderstatus") == "F"),
        ("close_nifty_500", F.col("o_orderstatus") == "O"),
        ("close_nifty_healthcare", F.col("o_orderstatus") == "P"),
        ("close_nifty_IT", F.col("o_orderpriority") == "1-URGENT"),
        ("close_nifty_pharma", F.col("o_orderpriority") == "5-LOW"),
    ]
    out = []
    for name, cond in specs:
        out.append(o.where(cond).groupBy(F.to_date("o_orderdate").alias("d"))
                   .agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
                         / F.count("o_totalprice")).cast("string").alias("Close"))
                   .select(F.date_format("d", "dd MMM yyyy").alias("Date"), "Close"))
    return out
