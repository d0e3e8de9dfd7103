"""Prefix scans: ranges, ranks and fills over any order, against plain Python and one window."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from daybook.operators import fills, scans
from tests.conftest import rows


def plan_of(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=15, deadline=None)
@given(cuts=st.lists(st.integers(-50, 50), max_size=150, unique=True).map(sorted),
       values=st.lists(st.one_of(st.none(), st.integers(-60, 60)), min_size=1, max_size=40))
def test_range_of(spark, cuts, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = df.select("v", scans.range_of(F.col("v"), cuts).alias("r")).collect()
    assert [r["r"] for r in got] == [None if v is None else scans.range_of_value(v, cuts) for v in values]


def test_cuts_make_even_ranges_of_a_skewed_order(spark):
    """Nine tenths of the rows within one hundredth of the values."""
    rng = random.Random(1)
    values = [rng.uniform(40, 50) if i % 10 else rng.uniform(0, 1000) for i in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    cuts = scans.range_cuts(df, "v", 20)
    assert len(cuts) == 19 and cuts == sorted(cuts)
    sizes = [r["count"] for r in df.groupBy(scans.range_of(F.col("v"), cuts).alias("r")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3 * 20_000 / 20


@pytest.mark.parametrize("kind, make", [
    ("bigint", lambda i: i * 7919 % 1000 - 500), ("string", lambda i: f"k{i * 7919 % 1000:04}é"),
    ("date", lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i * 7919 % 1000)),
    ("double", lambda i: (i * 7919 % 1000) / 7), ("boolean", lambda i: i % 3 == 0)])
def test_fill_by_any_order_equals_one_window(spark, kind, make):
    """Every type; one key with most of the rows; ties and null order values."""
    rng = random.Random(2)
    data = [("hot" if i % 10 else rng.choice(["a", "b", None]), None if i % 97 == 0 else make(i), i,
             rng.choice([None, None, None, float(i)]), rng.choice([None, f"s{i}"])) for i in range(3000)]
    df = spark.createDataFrame(data, f"k string, t {kind}, i int, v double, s string").repartition(5)
    for keys in ([], ["k"]):
        before = Window.partitionBy(*keys).orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
        after = Window.partitionBy(*keys).orderBy("t", "i").rowsBetween(0, Window.unboundedFollowing)
        want = lambda f, w: rows(df.select("i", f("v", True).over(w), f("s", True).over(w)))
        got = lambda f: rows(f(df, ["v", "s"], "t", keys, method="scan", ties=["i"]), "i", "v", "s")
        assert got(fills.fill_forward) == want(F.last, before)
        assert got(fills.fill_backward) == want(F.first, after)


def test_hot_month_of_one_key_is_split(spark):
    """Nine tenths of the rows in one month of one key: no (key, range) holds many of them."""
    df = spark.range(40_000).select(
        F.lit("station").alias("k"), F.when(F.col("id") % 10 == 0, F.timestamp_seconds(F.col("id") * 2000))
        .otherwise(F.timestamp_seconds(F.col("id") + 5_000_000)).alias("t"),
        F.when(F.col("id") % 50 == 0, F.col("id")).alias("v"), "id")
    cuts = scans.range_cuts(df, "t", scans.ranges_for(df, range_rows=1000))
    sizes = df.groupBy("k", scans.range_of(F.col("t"), cuts)).count().agg(F.max("count")).first()[0]
    assert sizes < 4000
    out = fills.fill_forward(df, ["v"], "t", ["k"], method="scan", ties=["id"])
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(out, "id", "v") == rows(df.select("id", F.last("v", True).over(w)))


def test_global_rank(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(300)]), i) for i in range(5000)]
    df = spark.createDataFrame(data, "v int, i int").repartition(7)
    out = scans.with_global_rank(df, "v", "n", start=1, ties=["i"])
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted((r["n"], r["v"], r["i"]) for r in out.collect()) == [
        (n + 1, v, i) for n, (v, i) in enumerate(order)]
    assert "SinglePartition" not in plan_of(out)
    assert scans.with_global_rank(df.limit(0), "v").collect() == []
    assert [r["rank"] for r in scans.with_global_rank(df.limit(1), "v").collect()] == [0]


def test_document_positions_without_one_task(spark):
    from daybook.sources.readers import with_document_position
    names = [f"2021-{m:02}-{d:02}.pdf" for m in range(1, 13) for d in range(1, 29)]
    df = spark.createDataFrame([(n,) for n in names * 3] + [(None,)], "file_name string").repartition(5)
    out = with_document_position(df)
    assert "SinglePartition" not in plan_of(out)
    assert rows(out, "file_name", "doc_index") == sorted(
        [(n, i) for i, n in enumerate(names)] * 3 + [(None, None)], key=lambda t: (t[0] is not None, t[0] or ""))
