"""Run the whole daily regional roll-up on the reference's own input formats.

    python -m daybook.plans.run --cases cases.json --codes region_codes.csv \
        --reports report_cells.parquet --air air_quality.csv \
        --cities city_regions.csv --closes NAME=path.csv [NAME=path.csv ...] \
        --out /shared/output

``--reports`` is the table of extracted report cells (``file_name, doc_index,
table_index, row_index, cells``); ``--closes`` values may also be catalog
tables (``NAME=table:db.tbl``).  Stage outputs T3, T5, T6, T7 and T9 are
written as CSV (one folder per table, the upstream partitioning kept); T6 is
also written as Parquet and read back, so the questions reuse it instead of
recomputing the whole lineage.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas
from daybook.operators import joins
from daybook.operators.layouts import (cell_store, normalize_reports, rejected_cells,
                                       rejected_documents, rejected_rows)
from daybook.plans import questions, stages
from daybook.plans.report_rules import (REFERENCE_DISPATCH, REFERENCE_LAYOUTS,
                                        REFERENCE_MEASURES, REFERENCE_TRIM)
from daybook.sources import readers, sinks


#: Stages kept by day, with their day column.
BY_DAY = {"vaccination_region": "day", "cases_vaccination_region": "report_time", "pollution_region": "day",
          "combined_region": "report_time", "country_day": "report_time", "country_closes_day": "report_time"}


def read_closes(spark: SparkSession, specs: dict[str, str]) -> dict[str, DataFrame]:
    out = {}
    for name, src in specs.items():
        if src.startswith("table:"):
            out[name] = readers.read_catalog_table(spark, src[len("table:"):])
        else:
            out[name] = readers.read_csv(spark, src, schemas.INDEX_CLOSES)
    return out


def run(spark: SparkSession, cases: str, codes: str, reports: str, air: str, cities: str,
        closes: dict[str, str], out: str | None = None, by_day: bool = False) -> dict[str, DataFrame]:
    """Build every stage and question; write the deliverables when ``out`` is given.

    ``by_day`` also keeps T2, T3, T5, T6, T7 and T9 as tables partitioned by day
    under ``out/by_day``: a later run rewrites only the days whose rows changed.
    """
    records = readers.read_json_records(spark, cases)
    city_list = readers.read_csv(spark, cities, schemas.CITY_REGION)
    t1 = stages.case_table(records, readers.read_csv(spark, codes, schemas.REGION_CODES))
    cells = cell_store(spark.read.parquet(reports), REFERENCE_TRIM.anchor_text)
    read = normalize_reports(cells, REFERENCE_LAYOUTS, REFERENCE_DISPATCH, REFERENCE_TRIM,
                             REFERENCE_MEASURES, header_marker=stages.HEADER_MARKER, rejected=True)
    report_rows = read.drop("file_name", "row_index", "rejected")
    t2 = stages.vaccination_by_region(report_rows)
    rejects = rejected_rows(report_rows)
    t3 = stages.cases_with_vaccination(t1, t2)
    t4 = stages.station_day(readers.read_csv(spark, air, schemas.AIR_QUALITY))
    t5 = stages.pollution_by_region(t4, city_list)
    t6 = stages.combined_region(t3, t5)
    if out:
        t6 = stages.materialize(spark, t6, "combined_region")
    t7 = stages.country_by_day(t6)
    t8 = stages.closes_by_day(read_closes(spark, closes))
    t9 = stages.country_with_closes(t7, t8)
    result = {
        "case_table": t1, "vaccination_region": t2, "cases_vaccination_region": t3,
        "station_day": t4, "pollution_region": t5, "combined_region": t6, "country_day": t7,
        "closes_day": t8, "country_closes_day": t9,
        "index_performance": questions.index_performance(t8),
        "index_quarterly": questions.index_quarterly(t8),
        "confirmed_and_pm25": questions.measure_over_time(t6, ["confirmed", "pm25"]),
        "doses_and_cases": questions.doses_and_cases(t6),
        "deaths_per_quarter": questions.deaths_per_quarter(t6),
        "region_extremes": questions.region_extremes(t1),
        "region_ranking": questions.region_totals(t1),
        "rejected_report_rows": rejects,
        "rejected_report_cells": rejected_cells(read),
        "rejected_documents": rejected_documents(cells, REFERENCE_DISPATCH, REFERENCE_TRIM),
        "rejected_case_records": readers.rejected_json_records(spark, cases),
        "rejected_case_days": stages.rejected_cases(records),
        "ambiguous_cities": joins.ambiguous_keys(city_list, "Name of City", "State").select(
            F.col("Name of City").alias("city"), "n_values", F.array_join("values", "; ").alias("regions")),
    }
    if out:
        sinks.write_csv(t2, f"{out}/vaccination_region", sep="|")
        sinks.write_csv(rejects, f"{out}/rejected_report_rows")
        for name in ("rejected_documents", "rejected_report_cells", "rejected_case_records",
                     "rejected_case_days", "ambiguous_cities", "cases_vaccination_region", "pollution_region", "combined_region",
                     "country_day", "country_closes_day"):
            sinks.write_csv(result[name], f"{out}/{name}")
        for name, day in BY_DAY.items() if by_day else ():
            sinks.write_days(result[name], f"{out}/by_day/{name}", day)
    return result


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    for flag in ("cases", "codes", "reports", "air", "cities", "out"):
        ap.add_argument(f"--{flag}", required=flag != "out")
    ap.add_argument("--closes", nargs="+", required=True, metavar="NAME=PATH")
    ap.add_argument("--by-day", action="store_true", help="also keep day-partitioned tables")
    args = ap.parse_args(argv)
    from daybook.session import build_session
    spark = build_session(app="daybook-run")
    closes = dict(item.split("=", 1) for item in args.closes)
    res = run(spark, args.cases, args.codes, args.reports, args.air, args.cities, closes,
              args.out, args.by_day)
    res["region_extremes"].show(truncate=False)


if __name__ == "__main__":
    main()
