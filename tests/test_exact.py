"""Order-independent sums, skewed joins, table summaries, and bounds in bytes."""

import datetime as dt
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from daybook.functions.exact import exact_mean, exact_sum
from daybook.operators import aggregates as agg
from daybook.operators import joins
from tests.conftest import SF_SMALL, rows


def bits(x):
    return None if x is None else struct.pack("<d", x)


@pytest.mark.parametrize("low, high", [(-6, 6), (0, 15), (-14, -8), (20, 27)])
def test_exact_sum_is_right_and_independent_of_order(spark, low, high):
    rng = random.Random(low)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.uniform(low, high) for _ in range(4000)] + [0.0, -0.0]
    values += [-v for v in values[:1500]]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = {bits(df.repartition(n).orderBy(F.rand(n)).agg(exact_sum("v")).first()[0]) for n in (1, 2, 5)}
    assert len(got) == 1
    total = struct.unpack("<d", got.pop())[0]
    assert total == pytest.approx(math.fsum(values), rel=1e-15, abs=len(values) * 2.0 ** -72)


def test_exact_sum_of_odd_values(spark):
    df = spark.createDataFrame([("n", None), ("one", 0.1), ("big", 1e300), ("big", 1.0), ("inf", float("inf")),
                                ("inf", 1.0), ("nan", float("nan")), ("zero", -0.0), ("tiny", 1e-310)],
                               "k string, v double")
    got = {r["k"]: (r["s"], r["m"]) for r in
           df.groupBy("k").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()}
    assert got["n"] == (None, None) and got["one"] == (0.1, 0.1) and got["zero"] == (0.0, 0.0)
    assert got["big"][0] == 1e300 and got["inf"][0] == math.inf and math.isnan(got["nan"][0])
    assert got["tiny"] == (0.0, 0.0)                            # below the lowest part
    assert df.limit(0).agg(exact_sum("v")).first()[0] is None


@pytest.mark.parametrize("key", ["q12_mean_of_means", "q18_impute_mean", "q50_index_quarterly"])
def test_means_have_the_same_bits_under_any_partitioning(spark, key, monkeypatch):
    from __spark_entry__ import queries
    from daybook.plans import tables
    from daybook.sources.readers import read_table

    def run(parts):
        def shuffled(s, sf, name):
            df = read_table(s, sf, name)
            return df if not parts else df.repartition(parts).sortWithinPartitions(F.rand(parts))
        monkeypatch.setattr(tables, "table", shuffled)
        monkeypatch.setattr("daybook.plans.queries.table", shuffled)
        return sorted(tuple(bits(v) if isinstance(v, float) else str(v) for v in r)
                      for r in queries()[key](spark, SF_SMALL).collect())
    plain = run(0)
    assert plain and run(3) == plain and run(11) == plain


def test_skew_join_deals_out_hot_keys(spark):
    """Half of the rows on one key, some without a key, a fan-out of three."""
    n = 4000
    facts = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, F.lit("hot")).when(
        F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 300)).alias("k")).repartition(3)
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("hot", 3), ("none", 9), (None, 8)]
                                + [(f"k{i}", i) for i in range(0, 300, 2)], "name string, v int")
    assert joins.hot_keys(facts, "k") == ["hot"]
    for how in ("left", "inner"):
        want = rows(facts.join(dim, F.col("k") == F.col("name"), how))
        out = joins.skew_join(facts, dim, "k", "name", how, salts=16)
        assert out.columns == ["id", "k", "name", "v"] and rows(out) == want
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.skew_join(facts, dim, "k", "name", salts=16).withColumn("p", F.spark_partition_id())
        tasks = out.where(F.col("k") == "hot").groupBy("p").count().collect()
        assert len(tasks) >= 8 and max(t["count"] for t in tasks) < 0.4 * 3 * n / 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert joins.hot_keys(facts.limit(0), "k") == [] and joins.skew_join(facts.limit(0), dim, "k", "name").collect() == []
    with pytest.raises(ValueError):
        joins.skew_join(facts, dim, "k", "name", "right")


def test_large_fanout_join_takes_the_skew_join(spark, monkeypatch):
    monkeypatch.setattr(joins, "is_bounded", lambda df, *a: False)
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "c string, v int")
    assert rows(joins.fanout_join(facts, dim, "k", "c")) == rows(facts.join(dim, F.col("k") == F.col("c"), "left"))


def test_bounds_count_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, [1, 2], 5)] * 100, "s string, a array<int>, n int")
    assert joins.is_bounded(df, 100, 200_000) and not joins.is_bounded(df, 100, 50_000)
    assert not joins.is_bounded(df, 99) and joins.is_bounded(df.limit(0), 0)


def test_ambiguous_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", "x"), (None, "x"), ("c", None), ("c", "z")],
                               "city string, state string")
    assert [tuple(r) for r in joins.ambiguous_keys(df, "city", "state").where("city = 'a'").collect()] == [("a", 2, ["x", "y"])]


def test_table_summary_of_all_types_within_the_stated_errors(spark):
    rng = random.Random(7)
    n = 20_000
    data = [(rng.gauss(0, 5) if i % 9 else None, rng.randrange(5000), f"s{rng.randrange(800)}",
             dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(900)),
             dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randrange(10 ** 7)), bool(i % 3), [i], None)
            for i in range(n)]
    df = spark.createDataFrame(data, "d double, i int, s string, day date, t timestamp_ntz, b boolean, "
                                     "a array<int>, v string").repartition(6)
    got = {r["column_name"]: r for r in agg.table_summary(df).collect()}
    assert list(got) == df.columns and all(r["n_rows"] == n for r in got.values())
    for at, name in enumerate(df.columns):
        values = [r[at] for r in data if r[at] is not None]
        r = got[name]
        assert r["non_null"] == len(values)
        if name in ("d", "i"):
            mean = math.fsum(values) / len(values)
            assert (r["min_number"], r["max_number"]) == (min(values), max(values)) and r["mean"] == pytest.approx(mean)
            assert r["stddev"] == pytest.approx(math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1)))
        if name in ("s", "day", "t", "b") and values:
            assert (r["min_text"], r["max_text"]) == tuple(
                str(v).lower() if name == "b" else str(v) for v in (min(values), max(values)))
        if name not in ("a", "v"):
            true = len(set(values))
            assert abs(r["distinct_about"] - true) <= agg.DISTINCT_ERROR * true + 1
        if name in ("d", "i", "day", "t"):
            epoch = dt.datetime(1970, 1, 1)
            number = lambda v: v if isinstance(v, (int, float)) else (
                (v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)) - epoch).total_seconds()
            places = sorted(map(number, values))
            for q in (25, 50, 75):
                v = r[f"q{q}"]
                below = sum(p < v for p in places) / len(places)
                upto = sum(p <= v for p in places) / len(places)
                assert below - agg.RANK_ERROR <= q / 100 <= upto + agg.RANK_ERROR
    assert got["a"]["distinct_about"] is None and got["v"]["non_null"] == 0
    assert [r["n_rows"] for r in agg.table_summary(df.limit(0)).collect()] == [0] * 8
