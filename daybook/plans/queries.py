"""Registered queries: one per operator group of SURVEY §2, over the driver tables.

Every query reads whole tables (no id subsets, no row caps except where a
top-k is the feature) and returns a lazy DataFrame.  Column names match the
SQL oracles in :mod:`daybook.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daybook.functions import dates, numbers, text
from daybook.operators import aggregates as agg
from daybook.operators import fills, filters, joins, reshape
from daybook.plans import tables
from daybook.plans.tables import table

#: Event types pivoted into columns (the "pollutants" of the test tables).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# --------------------------------------------------------------------------- scans, scalars

def q01_json_field(spark: SparkSession, sf: str) -> DataFrame:
    """JSON payload -> struct, drop null records, flatten."""
    e = table(spark, sf, "events")
    return (e.select("event_id", F.from_json("props", "k BIGINT").alias("value"))
            .where(F.col("value").isNotNull())
            .select("event_id", "value.*"))


def q02_recode_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Recode a retired code, cut codes to their suffix, look names up."""
    cust = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("state"))
    cust = cust.withColumn("state", text.recode("state", {"n24": "n4"}))
    codes = tables.region_codes(spark, sf).select(
        text.code_suffix("3166-2 code").alias("code"),
        F.col("Subdivision name").alias("state_name"))
    return (joins.lookup_join(cust, codes, "state", "code", ["state_name"])
            .select("c_custkey", "state", "state_name"))


def q03_day_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """first 10 characters of the timestamp text."""
    e = table(spark, sf, "events")
    return e.select("event_id", text.prefix(F.col("ts").cast("string")).alias("day"))


def q04_split_cells(spark: SparkSession, sf: str) -> DataFrame:
    """numbers joined by a blank (null-propagating), split again by position."""
    li = table(spark, sf, "lineitem")
    supp = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_suppkey"))
    packed = text.join_blank(F.col("l_orderkey").cast("string"),
                             text.join_blank(F.col("l_partkey").cast("string"),
                                             supp.cast("string")))
    return li.select(
        "l_orderkey", "l_linenumber",
        *[text.split_part(packed, i).cast("bigint").alias(f"p{i}") for i in (1, 2, 3, 4)])


def q05_clean_number(spark: SparkSession, sf: str) -> DataFrame:
    """Grouped-digit text back to integers; missing -> 0; row sums."""
    o = table(spark, sf, "orders")
    a = F.format_number(F.floor("o_totalprice"), 0)
    b = (F.when(F.col("o_orderstatus") == "P", F.lit(None))
         .when(F.col("o_orderstatus") == "O", F.lit("nan"))
         .otherwise(F.concat(F.lit(" "), F.format_number(F.col("o_custkey") * 1000, 0))))
    return o.select("o_orderkey",
                    numbers.grouped_digits(a).alias("a_num"),
                    numbers.grouped_digits(b).alias("b_num"),
                    numbers.sum_grouped(a, b).alias("total"))


def q06_replace_values(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered literal replacements, then a keyed patch."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    out = filters.replace_values(c, "c_mktsegment", [
        ("AUTOMOBILE", "AUTO"), ("AUTO", "CAR"), ("BUILDING", "BUILDING*"),
        ("MACHINERY*", "MACHINE")])
    return filters.patch_where(out, "c_mktsegment", F.col("c_custkey") == 7, "PATCHED")


def q07_any_column(spark: SparkSession, sf: str) -> DataFrame:
    """Drop rows where any listed column holds the marker."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                             "l_linestatus")
    return filters.drop_rows_with_value(li, "R", ["l_returnflag", "l_linestatus"])


def q08_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Sums per (day, flag) with a constant source column."""
    li = table(spark, sf, "lineitem")
    rows = li.select(F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_quantity",
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return (agg.total_of(rows, ["day", "l_returnflag"], [
        numbers.sum0("l_quantity").alias("sum_qty"),
        numbers.sum0("price").cast("decimal(38,2)").cast("double").alias("sum_price"),
        F.count(F.lit(1)).alias("n_lines")])
        .withColumn("source", F.lit("lineitem")))


def q09_right_join_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Right join, then drop rows without the left key (Catalyst: inner join)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    joined = li.join(o, F.col("o_orderkey") == F.col("l_orderkey"), "right")
    return filters.drop_nulls(joined, ["l_orderkey"]).select(
        "l_orderkey", "l_linenumber", "o_orderdate", "o_totalprice")


def q10_filter_project(spark: SparkSession, sf: str) -> DataFrame:
    """Equality filter, negated conjunction, null fill, drop, rename."""
    c = table(spark, sf, "customer")
    c = filters.keep_where(c, F.col("c_mktsegment") == "BUILDING")
    c = filters.drop_where(c, (F.col("c_nationkey") == 3) & (F.col("c_acctbal") < 0))
    c = c.withColumn("c_name", F.when(F.col("c_nationkey") == 5, F.lit(None))
                     .otherwise(F.col("c_name")))
    c = filters.fill_constant(c, "c_name", "UNKNOWN")
    return (c.drop("c_mktsegment")
            .withColumnRenamed("c_custkey", "custkey")
            .withColumnRenamed("c_acctbal", "balance")
            .withColumnRenamed("c_nationkey", "region_key")
            .withColumnRenamed("c_name", "name"))


# --------------------------------------------------------------------------- pivots, fills

def station_day_means(spark: SparkSession, sf: str, exact: bool = False) -> DataFrame:
    """Readings pivoted to one mean column per pollutant by (station, day)."""
    r = tables.station_readings(spark, sf).withColumn("day", dates.day_of("timestamp"))
    return agg.pivot_mean(r, ["station_id", "day"], "pollutant", "value", EVENT_TYPES, exact=exact)


def q11_pivot_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean reading per station, day and event type, one column per type."""
    return station_day_means(spark, sf)


def q12_mean_of_means(spark: SparkSession, sf: str) -> DataFrame:
    """A2: station means averaged again per (day, station group), unweighted; the same bits
    whatever the order of rows."""
    p = station_day_means(spark, sf, exact=True).withColumn("station_group", F.pmod("station_id", F.lit(7)))
    return agg.group_mean(p, ["day", "station_group"], EVENT_TYPES, exact=True)


def q13_station_label(spark: SparkSession, sf: str) -> DataFrame:
    """City and board parts of station labels of four shapes."""
    p = table(spark, sf, "part")
    label = (F.when(F.col("p_size") < 10,
                    F.concat_ws("", "p_name", F.lit(", "), "p_brand", F.lit(" - "), "p_type"))
             .when(F.col("p_size") < 20,
                   F.concat_ws("", "p_type", F.lit(" - "), "p_name", F.lit(" - "), "p_brand"))
             .when(F.col("p_size") < 30,
                   F.concat_ws("", F.lit(" "), "p_name", F.lit(", "), "p_brand", F.lit(" ")))
             .otherwise(F.concat_ws("", "p_name", F.lit("-"))))
    return p.select("p_partkey", label.alias("label")).select(
        "p_partkey", "label", text.station_city("label").alias("city"),
        text.station_board("label").alias("board"))


def q14_fanout_join(spark: SparkSession, sf: str) -> DataFrame:
    """Left join to a list with repeated keys; every match is a row."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (joins.fanout_join(n, s, "n_nationkey", "s_nationkey")
            .select("n_nationkey", "n_name", "s_suppkey", "s_name"))


def q15_fill_backward(spark: SparkSession, sf: str) -> DataFrame:
    """Per-station backward fill in day order (weekly buckets exercise the carry)."""
    p = station_day_means(spark, sf)
    return fills.fill_backward(p, EVENT_TYPES, "day", ["station_id"],
                               bucket=F.trunc("day", "week"))


def q16_fill_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Per-station forward fill in day order."""
    p = station_day_means(spark, sf)
    return fills.fill_forward(p, EVENT_TYPES, "day", ["station_id"],
                              bucket=F.trunc("day", "week"))


def q17_round(spark: SparkSession, sf: str) -> DataFrame:
    """round half to even on the scaled binary value."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     numbers.round_half_even(F.col("l_extendedprice") * F.col("l_discount"))
                     .alias("disc_value"))


def q18_impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Missing means replaced by the station's mean, exactly summed."""
    return fills.impute_group_mean(station_day_means(spark, sf, exact=True), ["station_id"], EVENT_TYPES,
                                   exact=True)


def q19_mixed_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A5: daily decimal sum, count and mean in one aggregate."""
    o = table(spark, sf, "orders")
    return agg.total_of(o.select(F.to_date("o_orderdate").alias("day"), "o_totalprice"), ["day"], [
        numbers.sum0(F.col("o_totalprice").cast("decimal(18,2)"))
        .cast("decimal(38,2)").cast("double")
        .alias("sum_price"),
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("o_totalprice").alias("avg_price")])


def _daily_total(o: DataFrame, cond, name: str, key: str = "day") -> DataFrame:
    return (o.where(cond).groupBy(F.to_date("o_orderdate").alias(key))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
                 .cast("decimal(38,2)").cast("double")
                 .alias(name)))


def q20_series_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Daily series side by side (left-join chain), then a differently keyed join."""
    o = table(spark, sf, "orders")
    series = [_daily_total(o, F.col("o_orderstatus") == s, f"total_{s.lower()}")
              for s in ("F", "O", "P")]
    chain = joins.align_series(series, "day")
    counts = o.groupBy(F.to_date("o_orderdate").alias("Date")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return joins.join_keys_renamed(chain, counts, "day", "Date")


def q21_global_ffill(spark: SparkSession, sf: str) -> DataFrame:
    """A trading-day series (no weekends) aligned on all days, forward-filled
    in two phases (month buckets, then a carry over the month table)."""
    o = table(spark, sf, "orders")
    days = o.select(F.to_date("o_orderdate").alias("day")).distinct()
    trading = (_daily_total(o, F.col("o_orderpriority") == "1-URGENT", "urgent_total")
               .where(~F.dayofweek("day").isin(1, 7)))
    sparse = days.join(trading, "day", "left")
    return fills.fill_forward(sparse, ["urgent_total"], "day")


def q22_date_text(spark: SparkSession, sf: str) -> DataFrame:
    """render ``dd MMM yyyy``, parse it back, render ``yyyy-MM-dd``."""
    o = table(spark, sf, "orders")
    txt = F.date_format("o_orderdate", "dd MMM yyyy")
    return o.select("o_orderkey", txt.alias("date_text"),
                    dates.render_day(dates.parse_day_text(txt)).alias("day_text"))


def q23_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """Station-day means in long form; missing means stay as null rows."""
    return reshape.unpivot_long(station_day_means(spark, sf), ["station_id", "day"], EVENT_TYPES)


def q24_quarter_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean order value per quarter label."""
    o = table(spark, sf, "orders")
    return agg.mean_per_x(o.select(dates.quarter_label("o_orderdate").alias("quarter"),
                                   "o_totalprice"), "quarter", ["o_totalprice"]) \
        .withColumnRenamed("o_totalprice", "avg_price")


def nation_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Order value per customer nation, decimal; orders are pre-summed per customer."""
    o = table(spark, sf, "orders")
    per_cust = o.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    j = per_cust.join(c, F.col("o_custkey") == F.col("c_custkey"))
    j = joins.lookup_join(j, n, "c_nationkey", "n_nationkey", ["region"])
    total = F.sum("s").cast("decimal(38,2)").cast("double").alias("total")
    return agg.total_of(j, ["region"], [total])


def q25_arg_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """The nations with the largest and smallest totals (ties -> first name)."""
    return agg.arg_extremes(nation_totals(spark, sf), "region", "total")


def q26_top_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """O1/O2/O3: 20 most valuable orders, key as tie-break."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return reshape.top_rows(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


def q27_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Count, mean, sample stddev, min, max and time range."""
    e = table(spark, sf, "events")
    return e.agg(F.count("value").alias("n"), F.avg("value").alias("mean"),
                 F.stddev_samp("value").alias("stddev"), F.min("value").alias("min"),
                 F.max("value").alias("max"), F.min("ts").alias("first_ts"),
                 F.max("ts").alias("last_ts"))


def q28_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Per-column type and non-null count of the pivoted station table."""
    return agg.column_profile(station_day_means(spark, sf))


def q29_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct order statuses."""
    return agg.distinct_values(table(spark, sf, "orders"), "o_orderstatus")


def q30_union_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Union by name; columns absent on one side are null."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"),
                                          F.col("o_orderdate").alias("day"),
                                          F.col("o_totalprice").alias("amount"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"),
                                             F.col("l_shipdate").alias("day"),
                                             F.col("l_quantity").alias("qty"))
    return reshape.union_all_by_name([o, li])


def q31_anchor_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation from its last user turn on, after skipping turn 0."""
    cv = table(spark, sf, "conversations").select("conv_id", "turn", "role",
                                                  F.length("text").cast("bigint").alias("n_chars"))
    body = filters.skip_leading_rows(cv, "turn", 1)
    return filters.slice_from_last_anchor(body, ["conv_id"], "turn", F.col("role") == "user")


def q32_drop_empty_column(spark: SparkSession, sf: str) -> DataFrame:
    """P10: per (station, week) document, drop pollutant positions that are empty throughout."""
    from daybook.operators.layouts import drop_empty_positions
    long = reshape.unpivot_long(
        station_day_means(spark, sf).withColumn("week", F.trunc("day", "week")),
        ["station_id", "week", "day"], EVENT_TYPES)
    return drop_empty_positions(long, ["station_id", "week"], "variable", "value")


def q33_catalog_sql(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog view, read whole."""
    from daybook.sources.readers import read_catalog_table
    table(spark, sf, "orders").createOrReplaceTempView("daybook_orders")
    return read_catalog_table(spark, "daybook_orders").select("o_orderkey", "o_orderstatus",
                                                              "o_totalprice")


def q34_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write ``|``-separated text to the shared folder, read all parts back."""
    from daybook.session import scratch_path
    from daybook.sources.readers import read_csv
    from daybook.sources.sinks import write_csv
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(c, path, sep="|")
    return read_csv(spark, path, c.schema, sep="|")


def q35_text_helpers(spark: SparkSession, sf: str) -> DataFrame:
    """digit stripping, text -> double, two-line cells, token tail."""
    p = table(spark, sf, "part")
    two_line = F.concat("p_name", F.lit("\r("), "p_type", F.lit(" x)"))
    return p.select(
        "p_partkey",
        text.strip_digits("p_brand").alias("brand_letters"),
        numbers.to_double(F.regexp_replace("p_brand", "[^0-9]", "")).alias("brand_no"),
        numbers.to_double("p_type").alias("type_no"),
        text.first_token_tail("p_name").alias("name_tail"),
        text.two_line_head(two_line).alias("head"),
        text.two_line_tail(two_line).alias("tail"))


def q37_document_position(spark: SparkSession, sf: str) -> DataFrame:
    """Position of each line's daily file in the sorted file list."""
    from daybook.sources.readers import with_document_position
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".csv")).alias("file_name"))
    return with_document_position(li)


def q59_fill_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """W2 by a number: prices carried forward per return flag (one of three holds half of
    the rows) in the order of order key and line, cut into ranges of rows."""
    ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"]
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", *ties, F.when(
        F.col("l_discount") > 0.02, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("price"))
    return fills.fill_forward(li, ["price"], "l_orderkey", ["l_returnflag"], method="scan", ties=ties)


def q60_fill_text_key(spark: SparkSession, sf: str) -> DataFrame:
    """W3 by a text, without a key: the next known balance in the order of names."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.when(
        F.col("c_acctbal") > 4000, F.col("c_acctbal")).alias("c_acctbal"))
    return fills.fill_backward(c, ["c_acctbal"], "c_name", ties=["c_custkey"])


def q61_global_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Position of every order by value, greatest order key last among equals."""
    from daybook.operators.scans import with_global_rank
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_global_rank(o, "o_totalprice", "position", ties=["o_orderkey"]).select("o_orderkey", "position")


def q62_rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    """S1-S5 rejects: an order dump (JSON lines between wrapper lines) and a customer list
    (``|``-separated), some records of which are broken; every broken one with its text."""
    from daybook.session import scratch_path
    from daybook.sources import readers
    key = F.col("o_orderkey").cast("string")
    whole = F.concat(F.lit('{"value":{"k":'), key, F.lit(',"s":"'), "o_orderstatus", F.lit('"}},'))
    line = (F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit('{"value":{"k":'), key))
            .when(F.col("o_orderkey") % 89 == 0, F.concat(F.lit('{"other":'), key, F.lit("},")))
            .when(F.col("o_orderkey") % 83 == 0, F.concat(F.lit('{"value":{"k":"n'), key, F.lit('"}},')))
            .otherwise(whole))
    dump = scratch_path(spark, "orders-json")
    table(spark, sf, "orders").select(F.explode(F.array(
        F.when(F.col("o_orderkey") == 1, F.lit('{"rows": [')).otherwise(F.lit("")), line,
        F.when(F.col("o_orderkey") == 1, F.lit("]}")).otherwise(F.lit("")))).alias("value")).write.text(dump)
    record = StructType([StructField("k", LongType()), StructField("s", StringType())])
    json = readers.rejected_json_records(spark, dump, record).select(F.lit("orders").alias("source"), "reason", "text")
    key = F.col("c_custkey").cast("string")
    line = (F.when(F.col("c_custkey") % 50 == 0, F.concat_ws("|", key, "c_name", F.lit("1"), F.lit("extra")))
            .when(F.col("c_custkey") % 77 == 0, F.concat_ws("|", F.concat(F.lit("x"), key), "c_name", F.lit("1")))
            .when(F.col("c_custkey") % 61 == 0, key)
            .otherwise(F.concat_ws("|", key, "c_name", F.lit(""))))
    listed = scratch_path(spark, "customers-csv")
    table(spark, sf, "customer").select(line.alias("value")).write.text(listed)
    fields = StructType([StructField("k", LongType()), StructField("name", StringType()), StructField("n", LongType())])
    csv = readers.rejected_csv_records(spark, listed, fields, sep="|", header=False).select(
        F.lit("customers").alias("source"), F.lit("malformed").alias("reason"), "text")
    return json.unionByName(csv)


def q63_catalog_series(spark: SparkSession, sf: str) -> DataFrame:
    """Five close series saved as partitioned tables of a database, read back by
    SQL text; the condition on the partition column leaves the other years unread."""
    from daybook.plans.stages import CLOSE_SERIES, closes_by_day
    from daybook.session import scratch_path
    from daybook.sources import readers, sinks
    path = scratch_path(spark, "closes-tables")
    suffix = path.rsplit("-", 1)[1]
    found = {}
    for name, df in zip(CLOSE_SERIES, tables.closes_series(spark, sf)):
        full = f"daybook_{suffix}.{name}"
        sinks.save_table(df.withColumn("year", F.substring("Date", 8, 4).cast("int")), full, f"{path}/{name}", "year")
        found[name] = readers.read_catalog_sql(spark, full, ("Date", "Close"), "year BETWEEN 1995 AND 1996")
    return closes_by_day(found)


def q64_table_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Exact figures of every column of the orders in one pass (the sketches
    beside them are tested against exact counts)."""
    return agg.table_summary(table(spark, sf, "orders"), sketches=False)


def q65_skew_join(spark: SparkSession, sf: str) -> DataFrame:
    """Line items joined on a key of which one value holds a third of all rows and
    some rows none; hot keys are dealt over many tasks."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(
            F.col("l_orderkey") % 17 != 0, F.col("l_suppkey")).alias("suppkey"))
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return joins.skew_join(li, s, "suppkey", "s_suppkey").select("l_orderkey", "l_linenumber", "suppkey", "s_name")


def q66_ambiguous_names(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of customers' names listed under more than one nation."""
    c = table(spark, sf, "customer").select(F.substring("c_name", -3, 3).alias("name"), F.col("c_nationkey"))
    found = joins.ambiguous_keys(c, "name", "c_nationkey")
    return found.select("name", "n_values", F.array_join(F.col("values").cast("array<string>"), ",").alias("nations"))


OPERATOR_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items())
    if name.startswith("q") and name[1:3].isdigit() and callable(fn)
}
