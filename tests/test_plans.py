"""Physical-plan properties that matter at scale, checked on the executed plans."""

import datetime as dt

from pyspark.sql import functions as F

from daybook.functions.numbers import to_bigint
from daybook.operators import aggregates as agg
from daybook.operators import fills, joins, reshape
from daybook.operators.layouts import Layout, TrimRules, normalize_reports
from daybook.schemas import REPORT_CELLS
from daybook.sources import sinks
from tests.conftest import SF_SMALL, rows


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_fill_never_moves_the_data_to_one_partition(spark):
    df = spark.range(0, 400).select(
        (F.lit(dt.date(2020, 1, 1)) + F.col("id").cast("int")).alias("day"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    out = fills.fill_forward(df, ["v"], "day")
    plan = executed_plan(out)
    # the data is exchanged by bucket; only the per-bucket table (one row per
    # month) meets a single-partition exchange, above an aggregate
    assert "hashpartitioning(_bucket" in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = "\n".join(lines[i + 1:i + 4])
            assert "Aggregate" in below, below


def test_report_rows_are_not_shuffled_by_document(spark):
    cells = spark.createDataFrame(
        [("2020-01-01.pdf", 1, 0, i, [str(i), "Goa", str(i)]) for i in range(50)], REPORT_CELLS)
    lay = Layout("X", groups=(("dose_1",),))
    out = normalize_reports(cells, [lay], [((1,), "X")], TrimRules(0, default_skip=0), ["dose_1"])
    plan = executed_plan(out)
    assert "hashpartitioning(doc_index" not in plan
    assert "BroadcastHashJoin" in plan


def test_lookup_join_broadcasts_small_dimension(spark):
    facts = spark.range(1000).select((F.col("id") % 25).cast("string").alias("k"))
    dim = spark.range(25).select(F.col("id").cast("string").alias("k"),
                                 F.concat(F.lit("n"), F.col("id")).alias("name"))
    plan = executed_plan(joins.lookup_join(facts, dim, "k", "k", ["name"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scan_is_pruned_and_filtered(spark):
    from __spark_entry__ import queries
    df = queries()["q10_filter_project"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    df = queries()["q11_pivot_mean"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in plan


def test_no_python_udfs_anywhere(spark):
    from __spark_entry__ import queries
    for key in ("q36_layouts", "q44_pollution_region", "q13_station_label", "q05_clean_number"):
        plan = queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_pivot_is_one_aggregate(spark):
    df = spark.createDataFrame([("a", "co", 1.0), ("a", "no2", 2.0)], "k string, p string, v double")
    plan = executed_plan(agg.pivot_mean(df, ["k"], "p", "v", ["co", "no2"]))
    assert plan.count("Exchange hashpartitioning") <= 1 and "pivotfirst" not in plan.lower()


def test_small_operators(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2), "3"), (dt.datetime(2020, 1, 1), "4")],
                               "ts timestamp_ntz, s string")
    r = agg.time_range(df, "ts").collect()[0]
    assert (r["first_ts"], r["last_ts"]) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2))
    assert [x["s"] for x in reshape.sorted_by(df, "ts").collect()] == ["4", "3"]
    assert sinks.preview(df, 1).count() == 1
    assert rows(df.select(to_bigint("s").alias("n"))) == [(3,), (4,)]


def test_spread_only_when_under_partitioned(spark):
    from daybook.sources.readers import spread
    few = spark.range(0, 100, numPartitions=1)
    many = spark.range(0, 100, numPartitions=4)
    assert spread(few, 4).rdd.getNumPartitions() == 4
    assert spread(many, 4) is many
    assert sorted(r[0] for r in spread(few, 4).collect()) == list(range(100))


def test_handoff_writes_under_the_checkpoint_folder(spark):
    from daybook.session import checkpoint_dir
    df = sinks.handoff(spark.range(5), "unit")
    plan = df._jdf.queryExecution().executedPlan().toString()
    base = checkpoint_dir(spark).replace("file:", "")
    assert base.rstrip("/") in plan and "unit-" in plan
    assert df.count() == 5


def test_default_imputation_is_aggregate_and_join_not_window(spark):
    # one key holds almost every row: the default plan aggregates map-side and
    # joins back (AQE can split the join); a window would sort the key in one task
    df = spark.range(0, 2000).select(
        F.when(F.col("id") < 1900, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("double")).alias("v"))
    out = fills.impute_group_mean(df, ["k"], ["v"])
    plan = executed_plan(out)
    assert "Window" not in plan and "HashAggregate" in plan
    # hot-key gaps take the key's mean; single-row keys with a null have none
    assert out.where((F.col("k") == "hot") & F.col("v").isNull()).count() == 0
    assert out.where(F.col("v").isNull()).count() == len([i for i in range(1900, 2000) if i % 3 == 0])
