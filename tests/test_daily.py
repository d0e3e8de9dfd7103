"""Rejected records of the scans, saved tables read by SQL text, and tables kept by day."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from daybook.sources import readers, sinks
from tests.conftest import rows

D = dt.date


def test_rejected_json_records(spark, tmp_path):
    lines = ['{"rows": [', '{"value":{"k":1,"s":"a"}},', '{"value":{"k":"x","s":"b"}},', '{"value":{"k":3,', "", "   ",
             '{"other":4},', '{"value":null},', "not json", "]}", "[", "]", '{"value":{"s":"only"}}']
    (tmp_path / "dump.json").write_text("\n".join(lines))
    record = StructType([StructField("k", LongType()), StructField("s", StringType())])
    got = rows(readers.rejected_json_records(spark, str(tmp_path / "dump.json"), record))
    assert got == sorted([("dump.json", "malformed", '{"value":{"k":"x","s":"b"}},'),
                          ("dump.json", "malformed", '{"value":{"k":3,'), ("dump.json", "malformed", "not json"),
                          ("dump.json", "no value", '{"other":4},'), ("dump.json", "no value", '{"value":null},')])
    kept = rows(readers.read_json_records(spark, str(tmp_path / "dump.json"), record).where("k IS NOT NULL"))
    assert kept == [(1, "a")]
    (tmp_path / "empty.json").write_text("")
    assert readers.rejected_json_records(spark, str(tmp_path / "empty.json"), record).collect() == []


def test_rejected_csv_records(spark, tmp_path):
    (tmp_path / "list.csv").write_text('n,x,name\n1,1.5,a\n2,,\nx3,1,b\n4,2.5,c,more\n5\n6,"7.5","quoted, text"\n')
    schema = StructType([StructField("n", LongType()), StructField("x", DoubleType()), StructField("name", StringType())])
    got = rows(readers.rejected_csv_records(spark, str(tmp_path / "list.csv"), schema))
    assert got == [("list.csv", "4,2.5,c,more"), ("list.csv", "5"), ("list.csv", "x3,1,b")]


def test_partitions_of_a_saved_table_are_pruned(spark):
    from __spark_entry__ import queries
    from tests.conftest import SF_SMALL
    plan = queries()["q63_catalog_series"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(year") == 5
    assert plan.count(">= 1995), (year") == 5


def files(path):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns
            for r, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_write_days_rewrites_only_what_changed(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(D(2021, 1, d), r, d * 10 + r) for d in range(1, 6) for r in range(3)] + [(None, 9, 1), (None, 9, 1)]
    df = spark.createDataFrame(data, "day date, r int, v int")
    assert sinks.write_days(df, path, "day") == [None] + [f"2021-01-0{d}" for d in range(1, 6)]
    first = files(path)
    assert rows(sinks.read_days(spark, path), "day", "r", "v") == rows(df)
    assert sinks.write_days(df.repartition(7), path, "day") == [] and files(path) == first
    more = df.withColumn("v", F.when((F.col("day") == D(2021, 1, 3)) & (F.col("r") == 1), 77).otherwise(F.col("v")))
    more = more.unionByName(spark.createDataFrame([(D(2021, 1, 9), 0, 5)], df.schema))
    assert sinks.write_days(more, path, "day") == ["2021-01-03", "2021-01-09"]
    second = files(path)
    assert {f for f in first if "01-03" not in f} == {f for f in second if f in first}
    assert rows(sinks.read_days(spark, path), "day", "r", "v") == rows(more)
    none = sinks.write_days(df.limit(0), str(tmp_path / "none"), "day")
    assert none == [] and sinks.read_days(spark, str(tmp_path / "none"), df.schema).collect() == []
    # a repeated row, a day without rows
    fewer = more.where("day <> DATE'2021-01-02' OR day IS NULL").unionByName(spark.createDataFrame([(None, 9, 1)], df.schema))
    assert sinks.write_days(fewer, path, "day") == [None]
    assert rows(sinks.read_days(spark, path), "day", "r", "v") == rows(fewer)


def test_rerun_with_one_more_day_equals_a_full_run(spark, tmp_path):
    """A new report day rewrites its own day; the kept tables equal a run over everything."""
    from daybook import schemas
    from daybook.plans import run as runner
    d = str(tmp_path)
    (tmp_path / "codes.csv").write_text("Subdivision category,3166-2 code,Subdivision name\nstate,IN-GA,Goa\nstate,IN-KL,Kerala\n")
    (tmp_path / "cities.csv").write_text("Name of City,State\nPanaji,Goa\nKochi,Kerala\nKochi,Goa\n")
    names = [f for f in schemas.AIR_QUALITY.fieldNames()]

    def air(days):
        out = [",".join(names)]
        for day in days:
            out.append(f"\"Station 1, Panaji - SPCB\",Panaji,IN,pm25,{day}.5,2022-03-0{day}T00:00:00Z,u,s,1,1,1,g")
        (tmp_path / "air.csv").write_text("\n".join(out) + "\n")

    def cases(days):
        recs = ["{\"value\":{\"report_time\":\"2022-03-0%d\",\"state\":\"%s\",\"cured\":%d,\"death\":1,\"confirmed\":9}}," % (
            day, s, day) for day in days for s in ("ga", "kl")]
        (tmp_path / "cases.json").write_text("\n".join(['{"rows": [', *recs, "]}"]))

    def reports(days, name):
        data = [(f"2022-03-0{x}.pdf", 414 + x, 1, i, [str(i), r, str(x), "2", "3", "4", "5", "6", "7", "8", "40"])
                for x in days for i, r in enumerate(["A & N Islands", "Goa", "Kerala"])]
        data += [(f"2022-03-0{x}.pdf", 414 + x, 0, 0, ["t"]) for x in days]
        spark.createDataFrame(data, schemas.REPORT_CELLS).write.mode("overwrite").parquet(f"{d}/{name}")
    closes = {}
    for k in ("close_nifty_50", "close_nifty_500", "close_nifty_healthcare", "close_nifty_IT", "close_nifty_pharma"):
        (tmp_path / f"{k}.csv").write_text("Date,Open,High,Low,Close\n01 Mar 2022,1,1,1,5.5\n")
        closes[k] = f"{d}/{k}.csv"

    def run(days, out, name):
        air(days)
        cases(days)
        reports(days, name)
        return runner.run(spark, f"{d}/cases.json", f"{d}/codes.csv", f"{d}/{name}", f"{d}/air.csv",
                          f"{d}/cities.csv", closes, f"{d}/{out}", by_day=True)
    run([1, 2, 3], "kept", "r1")
    before = files(f"{d}/kept/by_day/vaccination_region")
    country = files(f"{d}/kept/by_day/country_day")
    run([1, 2, 3, 4], "kept", "r2")
    after = files(f"{d}/kept/by_day/vaccination_region")
    assert set(before) <= set(after) and all(after[f] == before[f] for f in before) and len(after) > len(before)
    assert any("03-04" in f for f in files(f"{d}/kept/by_day/country_day")) and len(country) < len(
        files(f"{d}/kept/by_day/country_day"))
    run([1, 2, 3, 4], "full", "r3")
    for name in runner.BY_DAY:
        assert rows(sinks.read_days(spark, f"{d}/kept/by_day/{name}")) == rows(
            sinks.read_days(spark, f"{d}/full/by_day/{name}")), name
    city = spark.read.option("header", True).csv(f"{d}/full/ambiguous_cities").collect()
    assert [tuple(r) for r in city] == [("Kochi", "2", "Goa; Kerala")]


@pytest.fixture(autouse=True)
def _utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
