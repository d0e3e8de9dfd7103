"""The stages T1-T9 and questions N1-N5 run end to end on the driver tables.

The adapters of :mod:`daybook.plans.tables` give the test tables the shape of
the reference's inputs; from there on the code is exactly the library's
stage and question functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.layouts import Layout, TrimRules, normalize_reports
from daybook.plans import questions, stages, tables
from daybook.plans.queries import EVENT_TYPES
from daybook.plans.report_rules import D1, D2, PA, PB, PREC, T1, TOTAL, TOTAL_CELL
from daybook.plans.tables import table
from daybook.sources.readers import spread
from daybook.schemas import CASE_MEASURES, DOSE_MEASURES

# --------------------------------------------------------------------------- fixed values
# Layouts of the report tables built from line items; the layout changes with
# the report date as the reference's reports do.
LINEITEM_LAYOUTS = [
    Layout("TA", groups=((D1,), (D2,), (TOTAL,))),
    Layout("TB", groups=((D1, D2), (T1,), (TOTAL,))),
    Layout("TC", groups=((D1,), (D2, T1), (PA, PB), (TOTAL,)), sums=((PREC, (PA, PB)),)),
    Layout("TD", groups=((D1, D2), (T1, PA), (TOTAL_CELL,)), group_cells=(1, 2, 1),
           sums=((TOTAL, (TOTAL_CELL, T1)), (PREC, (PA,)))),
]
LINEITEM_DISPATCH = [
    (((None, 19941231),), "TA"),
    (((19950101, 19961231),), "TB"),
    (((19970101, 19981231),), "TC"),
    (((19990101, None),), "TD"),
]
LINEITEM_TRIM = TrimRules(single_table_skip=0, default_skip=0)
LINEITEM_CLEANING = stages.CleaningRules(
    early_replacements=(("NATION_24*", "NATION_24"),),
    dropped_regions=(), dose_1_patches=(), zero_dose_days=(), missing_region_name=None,
    zero_dose_regions=(), late_replacements=(("NATION_23", "NATION_22"),))
CASE_RECODES = {"n24": "n4"}


def report_cells(spark: SparkSession, sf: str) -> DataFrame:
    """One extracted report row per line item: the day's report, the
    supplier's region and the numbers printed in the day's layout."""
    # every row below becomes formatted text and is parsed again: spread the
    # scan over all task slots if the file has fewer row groups than slots
    li = spread(table(spark, sf, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax"))
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = tables.small_table(spark, sf, "nation", ("n_nationkey", "n_name"))
    j = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    fmt = lambda c: F.format_number(c, 0)  # noqa: E731 - grouped digits "12,345"
    txt = lambda c: c.cast("string")       # noqa: E731 - values below 1,000 print alike
    d1 = F.col("l_quantity").cast("bigint")
    d2 = F.floor("l_extendedprice").cast("bigint")
    t1 = F.round(F.col("l_discount") * 100).cast("bigint")
    pa = F.col("l_linenumber").cast("bigint")
    pb = F.round(F.col("l_tax") * 100).cast("bigint")
    total = d1 + d2
    s_num = F.col("l_linenumber").cast("string")
    region = F.when(F.col("n_nationkey") == 24, F.concat("n_name", F.lit("*"))) \
        .otherwise(F.col("n_name"))
    year = F.year("l_shipdate")
    blank = F.lit(" ")
    # quantity, discount, line number and tax stay below 1,000: plain text
    cells = (F.when(year <= 1994, F.array(s_num, region, txt(d1), fmt(d2), fmt(total)))
             .when(year <= 1996, F.array(s_num, region, F.concat(txt(d1), blank, fmt(d2)),
                                         txt(t1), fmt(total)))
             .when(year <= 1998, F.array(s_num, region, txt(d1), F.concat(fmt(d2), blank, txt(t1)),
                                         F.concat(txt(pa), blank, txt(pb)), fmt(total)))
             .otherwise(F.array(s_num, region, F.concat(txt(d1), blank, fmt(d2)), txt(t1),
                                txt(pa), fmt(total))))
    return j.select(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".pdf")).alias("file_name"),
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("doc_index"),
        F.lit(0).alias("table_index"),
        F.col("l_linenumber").alias("row_index"),
        cells.alias("cells"))


def q36_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """§2.12: report rows of four layouts normalized into the eight measures."""
    return normalize_reports(report_cells(spark, sf), LINEITEM_LAYOUTS, LINEITEM_DISPATCH,
                             LINEITEM_TRIM, DOSE_MEASURES, header_marker="1st Dose")


def t1(spark, sf):
    return stages.case_table(tables.case_records(spark, sf), tables.region_codes(spark, sf),
                             CASE_RECODES)


def t2(spark, sf):
    return stages.vaccination_by_region(q36_layouts(spark, sf), LINEITEM_CLEANING)


def t3(spark, sf):
    return stages.cases_with_vaccination(t1(spark, sf), t2(spark, sf))


def readings(spark, sf):
    e = table(spark, sf, "events")
    sector = F.pmod("user_id", F.lit(10)).cast("string")
    return e.select(
        F.concat(F.lit("Sector-"), sector, F.lit(", Station "), F.col("user_id").cast("string"),
                 F.lit(" - SPCB")).alias("location"),
        F.concat(F.lit("City "), sector).alias("city"),
        F.lit("IN").alias("country"),
        F.col("event_type").alias("pollutant"), "value", F.col("ts").alias("timestamp"))


def city_list(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = tables.small_table(spark, sf, "nation", ("n_nationkey", "n_name"))
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.concat(F.lit("Station "), F.col("s_suppkey").cast("string"))
                    .alias("Name of City"), F.col("n_name").alias("State")))


def t4(spark, sf):
    return stages.station_day(readings(spark, sf), EVENT_TYPES)


def t5(spark, sf):
    return stages.pollution_by_region(t4(spark, sf), city_list(spark, sf), EVENT_TYPES)


def t6(spark, sf):
    return stages.combined_region(t3(spark, sf), t5(spark, sf), EVENT_TYPES)


def t7(spark, sf):
    return stages.country_by_day(t6(spark, sf), list(CASE_MEASURES) + list(DOSE_MEASURES),
                                 EVENT_TYPES)


def t8(spark, sf):
    return stages.closes_by_day(dict(zip(stages.CLOSE_SERIES, tables.closes_series(spark, sf))))


def t9(spark, sf):
    return stages.country_with_closes(t7(spark, sf), t8(spark, sf))


def q40_case_table(spark, sf):
    """Case records named by region lookup."""
    return t1(spark, sf)


def q41_vaccination_region(spark, sf):
    """Normalized report rows, cleaned, summed per (day, region)."""
    return t2(spark, sf)


def q42_cases_vaccination(spark, sf):
    """Cases right-joined to vaccination on (day, region)."""
    return t3(spark, sf)


def q43_station_day(spark, sf):
    """T4: station pollutant means per day with city and board from the label."""
    return t4(spark, sf)


def q44_pollution_region(spark, sf):
    """T5: region means per day, backward-filled, rounded."""
    return t5(spark, sf)


def q45_combined_region(spark, sf):
    """T3 with pollution, gaps imputed with region means."""
    return t6(spark, sf)


def q46_country_day(spark, sf):
    """Country sums and means per day."""
    return t7(spark, sf)


def q47_closes_day(spark, sf):
    """Five close series side by side per day."""
    return t8(spark, sf)


def q48_country_closes(spark, sf):
    """Country table with forward-filled closes (flagship deliverable)."""
    return t9(spark, sf)


def q50_index_quarterly(spark, sf):
    """Mean close per series and quarter."""
    return questions.index_quarterly(t8(spark, sf))


def q56_index_performance(spark, sf):
    """Every close of every day in long form."""
    return questions.index_performance(t8(spark, sf))


def q51_measure_series(spark, sf):
    """Cases and one pollutant over time by region."""
    return questions.measure_over_time(t6(spark, sf), ["confirmed", "purchase"])


def q52_doses_cases(spark, sf):
    """Daily mean doses and cases."""
    return questions.doses_and_cases(t6(spark, sf))


def q53_deaths_quarterly(spark, sf):
    """Mean deaths per quarter."""
    return questions.deaths_per_quarter(t6(spark, sf))


def q54_region_extremes(spark, sf):
    """Regions with the most and fewest deaths."""
    return questions.region_extremes(t1(spark, sf))


def q55_region_ranking(spark, sf):
    """All regions by deaths, most first."""
    return questions.region_totals(t1(spark, sf))


SHAPE_QUERIES = {name: fn for name, fn in sorted(globals().items())
                 if name.startswith("q") and name[1:3].isdigit() and callable(fn)}
