"""Operators against small fixtures (FIXTURES.md) and properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from daybook.operators import aggregates as agg
from daybook.operators import fills, filters, joins, reshape
from daybook.operators.layouts import drop_empty_positions
from tests.conftest import rows

D = dt.date


def test_drop_where_keeps_rows_whose_condition_is_null(spark):
    df = spark.createDataFrame([("2021-04-02", 0), ("2021-04-02", 5), (None, 0), ("x", None)],
                               "day string, dose_1 int")
    out = filters.drop_where(df, (F.col("day") == "2021-04-02") & (F.col("dose_1") == 0))
    assert rows(out) == [(None, 0), ("2021-04-02", 5), ("x", None)]


def test_replace_values_in_order_and_literal(spark):
    df = spark.createDataFrame([("A",), ("B",), ("Punjab*",), ("Punjabi",), (None,)], "s string")
    out = filters.replace_values(df, "s", [("A", "B"), ("B", "C"), ("Punjab*", "Punjab")])
    assert rows(out) == [(None,), ("C",), ("C",), ("Punjab",), ("Punjabi",)]


def test_drop_rows_with_marker_in_any_column(spark):
    df = spark.createDataFrame([("1st Dose", "x"), ("a", "1st Dose"), ("a", None), (None, None)],
                               "a string, b string")
    assert rows(filters.drop_rows_with_value(df, "1st Dose")) == [(None, None), ("a", None)]


def test_patch_then_fill_constant(spark):
    df = spark.createDataFrame([(5250505, "Wrong"), (1, None), (2, "Goa")], "d int, r string")
    out = filters.patch_where(df, "r", F.col("d") == 5250505, "Himachal Pradesh")
    out = filters.fill_constant(out, "r", "Dadra and Nagar Haveli")
    assert rows(out) == [(1, "Dadra and Nagar Haveli"), (2, "Goa"), (5250505, "Himachal Pradesh")]


def test_slice_from_last_anchor(spark):
    df = spark.createDataFrame(
        [(1, 0, "x"), (1, 1, "A"), (1, 2, "y"), (1, 3, "A"), (1, 4, "z"), (2, 0, "p"), (2, 1, "q")],
        "doc int, r int, name string")
    out = filters.slice_from_last_anchor(df, ["doc"], "r", F.col("name") == "A")
    assert rows(out, "doc", "r") == [(1, 3), (1, 4), (2, 0), (2, 1)]


def test_lookup_join_is_unique_and_keeps_unmatched(spark):
    facts = spark.createDataFrame([("dh", 1), ("kl", 2), ("zz", 3)], "state string, v int")
    codes = spark.createDataFrame([("dh", "Dadra A"), ("dh", "Dadra B"), ("kl", "Kerala")],
                                  "code string, name string")
    out = joins.lookup_join(facts, codes, "state", "code", ["name"])
    assert out.count() == 3
    assert rows(out, "state", "name") == [("dh", "Dadra B"), ("kl", "Kerala"), ("zz", None)]


def test_fanout_join(spark):
    st_ = spark.createDataFrame([("Srinagar", 1.0), ("Gurugram", 2.0), ("Nowhere", 3.0)],
                                "city string, v double")
    cities = spark.createDataFrame(
        [("Srinagar", "Jammu and Kashmir"), ("Srinagar", "Uttarakhand"),
         ("Gurugram", "Haryana"), ("Gurugram", "Haryana")], "name string, state string")
    out = joins.fanout_join(st_, cities, "city", "name")
    assert out.count() == 5
    assert rows(out.where(F.col("city") == "Nowhere"), "state") == [(None,)]
    # same rows when the dimension is the large side (facts broadcast + anti join)
    big_dim = joins.fanout_join(st_, cities, "city", "name", max_rows=3)
    assert rows(big_dim.select(*out.columns)) == rows(out)
    # and when both sides are large (plain shuffled left join)
    both = joins.fanout_join(st_, cities, "city", "name", max_rows=1)
    assert rows(both.select(*out.columns)) == rows(out)


def test_bounded_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "broadcast" in str(joins.bounded_broadcast(small, 100)._jdf.queryExecution()
                              .logical()).lower()
    assert "broadcast" not in str(joins.bounded_broadcast(big, 100)._jdf.queryExecution()
                                  .logical()).lower()


def test_align_series_and_renamed_keys(spark):
    a = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 2), 2.0)], "Date date, a double")
    b = spark.createDataFrame([(D(2020, 1, 2), 20.0)], "Date date, b double")
    chain = joins.align_series([a, b], "Date")
    assert rows(chain) == [(D(2020, 1, 1), 1.0, None), (D(2020, 1, 2), 2.0, 20.0)]
    c = spark.createDataFrame([(D(2020, 1, 2), 5)], "report_time date, n int")
    out = joins.join_keys_renamed(c, chain, "report_time", "Date")
    assert out.columns == ["report_time", "n", "a", "b"]


def test_group_sum_rules(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 5), ("b", 2), ("b", 3)],
                               "k string, v bigint")
    assert rows(agg.group_sum(df, ["k"], ["v"])) == [("a", 0), ("b", 5)]


def test_pivot_mean_semantics(spark):
    df = spark.createDataFrame([
        ("s1", "co", 1.0), ("s1", "co", 3.0), ("s1", "no2", 4.0),   # mean of two readings
        ("s2", "co", None),                                         # only a null: no row
        ("s3", "bc", 7.0),                                          # unlisted pollutant only
    ], "k string, p string, v double")
    out = agg.pivot_mean(df, ["k"], "p", "v", ["co", "no2"])
    assert rows(out) == [("s1", 2.0, 4.0), ("s3", None, None)]


def test_mean_of_means_is_unweighted(spark):
    df = spark.createDataFrame([("r", "s1", 1.0), ("r", "s2", 3.0), ("r", "s2", 3.0),
                                ("r", "s2", 3.0)], "region string, st string, v double")
    per_station = agg.group_mean(df, ["region", "st"], ["v"])
    assert rows(agg.group_mean(per_station, ["region"], ["v"])) == [("r", 2.0)]


def test_arg_extremes_ties_go_to_first_name(spark):
    df = spark.createDataFrame([("b", 10), ("a", 10), ("c", 1), ("d", 1)], "region string, d bigint")
    r = agg.arg_extremes(df, "region", "d").collect()[0]
    assert (r["max_region"], r["max_d"], r["min_region"], r["min_d"]) == ("a", 10, "c", 1)


def test_summary_profile_distinct(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "a")], "x double, s string")
    s = agg.summary(df, "x").collect()[0]
    assert (s["n"], s["mean"], s["min"], s["max"]) == (2, 2.0, 1.0, 3.0)
    assert abs(s["stddev"] - 2 ** 0.5) < 1e-12
    assert rows(agg.column_profile(df)) == [("s", "string", 2), ("x", "double", 2)]
    assert rows(agg.distinct_values(df, "s")) == [(None,), ("a",)]


FILL_ROWS = [("A", D(2020, 1, 1), None), ("A", D(2020, 1, 2), 5.0), ("A", D(2020, 2, 3), None),
             ("A", D(2020, 3, 4), 7.0), ("B", D(2020, 1, 1), 1.0), ("B", D(2020, 2, 2), None)]


def test_fill_backward_and_forward_fixture(spark):
    df = spark.createDataFrame(FILL_ROWS, "region string, day date, co double")
    back = fills.fill_backward(df, ["co"], "day", ["region"])
    fwd = fills.fill_forward(df, ["co"], "day", ["region"])
    assert [r[2] for r in rows(back)] == [5.0, 5.0, 7.0, 7.0, 1.0, None]
    assert [r[2] for r in rows(fwd)] == [None, 5.0, 5.0, 7.0, 1.0, 1.0]
    both = fills.fill_both(df, ["co"], "day", ["region"])
    assert [r[2] for r in rows(both)] == [5.0, 5.0, 5.0, 7.0, 1.0, 1.0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 120),
                          st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])))
def test_two_phase_fill_equals_single_window(spark, data):
    df = spark.createDataFrame([(k, D(2020, 1, 1) + dt.timedelta(days=d), v) for k, d, v in data],
                               "k int, day date, v int")
    for direction in (fills.FORWARD, fills.BACKWARD):
        two = fills.fill_gaps(df, ["v"], "day", ["k"], direction)
        if direction == fills.FORWARD:
            w = Window.partitionBy("k").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
            one = df.select("k", "day", F.last("v", True).over(w).alias("v"))
        else:
            w = Window.partitionBy("k").orderBy("day").rowsBetween(0, Window.unboundedFollowing)
            one = df.select("k", "day", F.first("v", True).over(w).alias("v"))
        assert rows(two) == rows(one)
    glob = fills.fill_forward(df.where(F.col("k") == 0), ["v"], "day")
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.where(F.col("k") == 0).select("k", "day", F.last("v", True).over(w).alias("v"))
    assert rows(glob) == rows(ref)


def test_fill_is_idempotent(spark):
    df = spark.createDataFrame(FILL_ROWS, "region string, day date, co double")
    once = fills.fill_forward(df, ["co"], "day", ["region"])
    assert rows(fills.fill_forward(once, ["co"], "day", ["region"])) == rows(once)


def test_impute_group_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, None)],
                               "k string, v double")
    assert rows(fills.impute_group_mean(df, ["k"], ["v"])) == \
        [(None, None), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None)]


def test_unpivot_keeps_nulls_and_roundtrips_pivot(spark):
    df = spark.createDataFrame([("s1", "co", 1.0), ("s1", "no2", 4.0), ("s2", "co", 2.0)],
                               "k string, p string, v double")
    wide = agg.pivot_mean(df, ["k"], "p", "v", ["co", "no2"])
    long = reshape.unpivot_long(wide, ["k"], ["co", "no2"], "p", "v")
    assert long.count() == 4
    assert rows(long.where(F.col("v").isNotNull())) == rows(df)


def test_union_by_name_and_top_rows(spark):
    a = spark.createDataFrame([(1, 2.0)], "key int, amount double")
    b = spark.createDataFrame([(2, 3.0)], "key int, qty double")
    assert rows(reshape.union_all_by_name([a, b])) == [(1, 2.0, None), (2, None, 3.0)]
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(20)], "k int, v double")
    top = reshape.top_rows(df, [F.col("v").desc(), F.col("k")], 3)
    assert [r["k"] for r in top.collect()] == [4, 9, 14]


def test_drop_empty_positions(spark):
    df = spark.createDataFrame([("d1", "co", None), ("d1", "co", None), ("d1", "no2", 1.0),
                                ("d2", "co", 2.0)], "doc string, pos string, v double")
    assert rows(drop_empty_positions(df, ["doc"], "pos", "v")) == \
        [("d1", "no2", 1.0), ("d2", "co", 2.0)]


def test_window_methods_equal_default_methods(spark):
    df = spark.createDataFrame(FILL_ROWS, "region string, day date, co double")
    for direction in (fills.FORWARD, fills.BACKWARD):
        assert rows(fills.fill_gaps(df, ["co"], "day", ["region"], direction, method="window")) \
            == rows(fills.fill_gaps(df, ["co"], "day", ["region"], direction))
    imp = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, None)],
                                "k string, v double")
    assert rows(fills.impute_group_mean(imp, ["k"], ["v"], method="window")) == \
        rows(fills.impute_group_mean(imp, ["k"], ["v"]))


def test_window_fill_refuses_global_window(spark):
    import pytest
    df = spark.createDataFrame(FILL_ROWS, "region string, day date, co double")
    with pytest.raises(ValueError):
        fills.fill_forward(df, ["co"], "day", method="window")


def test_two_phase_fill_carries_null_keys_like_the_window(spark):
    rows = [(None, "2020-01-01", 5.0), (None, "2020-01-02", None), (None, "2020-02-01", None),
            ("a", "2020-01-05", None), ("a", "2020-03-01", 2.0), ("a", None, None), ("a", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.to_date("d"))
    for fill in (fills.fill_forward, fills.fill_backward):
        want = sorted(map(str, fill(df, ["v"], "d", ["k"], method="window").collect()))
        got = sorted(map(str, fill(df, ["v"], "d", ["k"]).collect()))
        if fill is fills.fill_forward:
            assert str(fill(df, ["v"], "d", ["k"]).where("k IS NULL AND v IS NULL").count()) == "0"
        assert got == want


def test_document_position(spark):
    from daybook.sources.readers import with_document_position
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "file_name string")
    got = {(r.file_name, r.doc_index) for r in with_document_position(df).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2), (None, None)}


def test_text_that_is_no_day_is_null_and_listed(spark):
    from daybook.plans.stages import case_table, rejected_cases
    cases = spark.createDataFrame([("2020-01-30T00:00", "kl", 1), ("soon", "kl", 2), (None, "xx", 3)],
                                  "report_time string, state string, confirmed int")
    codes = spark.createDataFrame([("IN-KL", "Kerala")], ["3166-2 code", "Subdivision name"])
    got = {r.confirmed: (str(r.report_time), r.state_name) for r in case_table(cases, codes).collect()}
    assert got == {1: ("2020-01-30", "Kerala"), 2: ("None", "Kerala"), 3: ("None", None)}
    assert [r.report_time for r in rejected_cases(cases).collect()] == ["soon"]
