"""The stages of the daily regional roll-up.

Each stage is a function from DataFrames to a DataFrame in the reference's
column vocabulary; nothing is collected and nothing is written unless the
caller asks for it (:func:`materialize`).  Parameters default to the
reference's fixed values; adapters in :mod:`daybook.plans.shapes` pass the
test-table equivalents.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import dates, numbers, text
from daybook.operators import aggregates as agg
from daybook.operators import fills, filters, joins
from daybook.schemas import CASE_MEASURES, DOSE_MEASURES, POLLUTANTS
from daybook.sources.sinks import handoff

# --------------------------------------------------------------------------- fixed values
# Fixed values of the reference's cleaning, in the order the reference applies them.

#: Retired region code recoded to its successor before the name lookup.
CASE_CODE_RECODES = {"dn_dd": "dh"}

#: Name replacements applied first (carriage returns from extraction, short names, stars).
EARLY_NAME_REPLACEMENTS = [
    ("Andaman and Nicobar\rIslands", "Andaman and Nicobar Islands"),
    ("Dadra & Nagar\rHaveli", "Dadra & Nagar Haveli"),
    ("Arunachal\rPradesh", "Arunachal Pradesh"),
    ("A & N Islands", "Andaman and Nicobar Islands"),
    ("Punjab*", "Punjab"),
    ("Chhattisgarh*", "Chhattisgarh"),
]
#: Region rows dropped outright.
DROPPED_REGIONS = ["Haveli"]
#: Rows whose first-dose count identifies the region whatever the name says.
DOSE_1_PATCHES = [(5250505, "Himachal Pradesh"), (5789969, "Jammu & Kashmir")]
#: Report days whose zero first-dose rows are dropped.
ZERO_DOSE_DAYS = ["2021-04-02"]
#: Name given to rows without a region name.
MISSING_REGION_NAME = "Dadra and Nagar Haveli"
#: Region names whose zero first-dose rows are dropped.
ZERO_DOSE_REGIONS = ["Dadra & Nagar"]
#: Name replacements applied last (merging the union territory's three names).
LATE_NAME_REPLACEMENTS = [
    ("Dadra and Nagar Haveli", "Dadra and Nagar Haveli and Daman and Diu"),
    ("Dadra & Nagar Haveli", "Dadra and Nagar Haveli and Daman and Diu"),
    ("Daman & Diu", "Dadra and Nagar Haveli and Daman and Diu"),
    ("Jammu & Kashmir", "Jammu and Kashmir"),
]
#: Marker of header rows repeated inside report bodies.
HEADER_MARKER = "1st Dose"
#: Country code kept from the air-quality export.
COUNTRY = "IN"
#: Index close series, in column order.
CLOSE_SERIES = ["close_nifty_50", "close_nifty_500", "close_nifty_healthcare",
                "close_nifty_IT", "close_nifty_pharma"]


@dataclass(frozen=True)
class CleaningRules:
    """The vaccination cleaning sequence; order of the fields is order of application."""

    early_replacements: Sequence[tuple[str, str]] = tuple(EARLY_NAME_REPLACEMENTS)
    dropped_regions: Sequence[str] = tuple(DROPPED_REGIONS)
    dose_1_patches: Sequence[tuple[int, str]] = tuple(DOSE_1_PATCHES)
    zero_dose_days: Sequence[str] = tuple(ZERO_DOSE_DAYS)
    missing_region_name: str | None = MISSING_REGION_NAME
    zero_dose_regions: Sequence[str] = tuple(ZERO_DOSE_REGIONS)
    late_replacements: Sequence[tuple[str, str]] = tuple(LATE_NAME_REPLACEMENTS)
    measures: Sequence[str] = field(default_factory=lambda: tuple(DOSE_MEASURES))


# --------------------------------------------------------------------------- T1

def case_table(cases: DataFrame, codes: DataFrame,
               recodes: Mapping[str, str] = CASE_CODE_RECODES) -> DataFrame:
    """Case records with region names and a day.

    ``cases``: ``report_time`` (text or timestamp), ``state`` (short code),
    measures.  ``codes``: the region code table (``3166-2 code``,
    ``Subdivision name``).  Codes are cut to their suffix (F2), made unique
    and broadcast after a size check (J1); unmatched cases keep a null name,
    and text that is no day becomes a null day (``rejected_cases`` lists it).
    """
    c = cases.withColumn("state", text.recode("state", dict(recodes)))
    lookup = codes.select(text.code_suffix("3166-2 code").alias("code"),
                          F.col("Subdivision name").alias("state_name"))
    named = joins.lookup_join(c, lookup, "state", "code", ["state_name"])
    day = text.prefix(F.col("report_time").cast("string"), 10).try_cast("date")
    return named.withColumn("report_time", day)


def rejected_cases(cases: DataFrame) -> DataFrame:
    """Case records whose ``report_time`` is not a day, with the original text."""
    written = F.col("report_time").cast("string")
    return cases.where(written.isNotNull() & text.prefix(written, 10).try_cast("date").isNull())


# --------------------------------------------------------------------------- T2

def clean_vaccination(rows: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """T2 cleaning of normalized report rows ``(day, region, measures...)``.

    Steps in the reference's order; every drop keeps rows whose condition is
    null (pandas compares a missing value as false).
    """
    r = filters.replace_values(rows, "region", list(rules.early_replacements))
    if rules.dropped_regions:
        r = filters.drop_where(r, F.col("region").isin(*rules.dropped_regions))
    for dose_1, name in rules.dose_1_patches:
        r = filters.patch_where(r, "region", F.col("dose_1") == F.lit(dose_1), name)
    if rules.zero_dose_days:
        r = filters.drop_where(r, F.col("day").isin(*[F.lit(d).cast("date")
                                                      for d in rules.zero_dose_days])
                               & (F.col("dose_1") == 0))
    if rules.missing_region_name is not None:
        r = filters.fill_constant(r, "region", rules.missing_region_name)
    if rules.zero_dose_regions:
        r = filters.drop_where(r, F.col("region").isin(*rules.zero_dose_regions)
                               & (F.col("dose_1") == 0))
    return filters.replace_values(r, "region", list(rules.late_replacements))


def vaccination_by_region(rows: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Cleaned report rows summed per (day, region) (A1; merged names add up).

    The rows are written first: the drops of the cleaning would otherwise move
    into the reading of the report cells, which then runs once for each of them.
    """
    used = {"day", "region", "dose_1", *rules.measures}
    rows = handoff(rows.select(*[c for c in rows.columns if c in used]), "report-rows")
    cleaned = clean_vaccination(rows, rules)
    return agg.group_sum(cleaned, ["day", "region"], list(rules.measures))


# --------------------------------------------------------------------------- T3

def cases_with_vaccination(cases: DataFrame, vaccination: DataFrame,
                           case_measures: Sequence[str] = CASE_MEASURES,
                           dose_measures: Sequence[str] = DOSE_MEASURES) -> DataFrame:
    """Every vaccination row with the case measures of its (day, region).

    Right join, keys taken from the case side (null where no case row
    matches, as in the reference's deliverable).
    """
    v = vaccination.withColumnRenamed("day", "_v_day").withColumnRenamed("region", "_v_region")
    j = cases.join(v, (F.col("report_time") == F.col("_v_day"))
                   & (F.col("state_name") == F.col("_v_region")), "right")
    return j.select("report_time", "state_name", *case_measures, *dose_measures)


# --------------------------------------------------------------------------- T4

def station_day(readings: DataFrame, pollutants: Sequence[str] = POLLUTANTS,
                country: str | None = COUNTRY) -> DataFrame:
    """T4: pollutant means per (station, day), with city and board from the label.

    Readings: ``location, city, country, pollutant, value, timestamp``.  The
    country filter and the column selection reach the scan.
    """
    r = readings
    if country is not None:
        r = r.where(F.col("country") == country)
    r = r.withColumn("day", dates.day_of("timestamp"))
    keys = [k for k in ("country", "city", "location") if k in r.columns] + ["day"]
    wide = agg.pivot_mean(r, keys, "pollutant", "value", list(pollutants))
    return (wide.withColumn("city_refined", text.station_city("location"))
            .withColumn("pollution_board", text.station_board("location")))


# --------------------------------------------------------------------------- T5

def pollution_by_region(stations: DataFrame, city_regions: DataFrame,
                        pollutants: Sequence[str] = POLLUTANTS, fill: str = "backward",
                        places: int | None = 2) -> DataFrame:
    """T5: station means -> region means per day, gaps filled, rounded.

    The city list is a bounded dimension joined after a size check; repeated
    city names fan a station out to every listed region (the reference's
    behaviour).  Means are unweighted means of station means.  ``fill`` is
    ``backward`` (what the reference's code ends up doing), ``forward``,
    ``both`` or ``none``.  Means are summed exactly, so that the rounding
    (F14) does not depend on summation order.
    """
    cities = city_regions.select(F.col("Name of City").alias("_city"), F.col("State"))
    j = joins.fanout_join(stations, cities, "city_refined", "_city")
    region = agg.group_mean_exact(j, ["day", "State"], list(pollutants)) \
        .withColumnRenamed("State", "region")
    # one row per (day, region): a region's series is bounded by the number
    # of days, so a plain per-region window is the cheapest correct plan
    if fill == "backward":
        region = fills.fill_backward(region, list(pollutants), "day", ["region"], method="window")
    elif fill == "forward":
        region = fills.fill_forward(region, list(pollutants), "day", ["region"], method="window")
    elif fill == "both":
        region = fills.fill_both(region, list(pollutants), "day", ["region"], method="window")
    if places is not None:
        for p in pollutants:
            region = region.withColumn(p, numbers.round_half_even(p, places))
    return region


# --------------------------------------------------------------------------- T6

def combined_region(cases_vacc: DataFrame, pollution: DataFrame,
                    pollutants: Sequence[str] = POLLUTANTS) -> DataFrame:
    """T3 with the day's regional pollution; missing values take the
    region's mean (J4); rows without a day are dropped.

    The drop comes first: a T3 row without a day is a vaccination row no case
    matched, so its region is null as well and it never contributes to a
    region's mean.  The table has one row per (day, region), so a region's
    group is bounded by the number of days and the mean is a window over the
    region: one shuffle, and the upstream is read once.
    """
    p = pollution.withColumnRenamed("day", "_p_day").withColumnRenamed("region", "_p_region")
    dated = filters.drop_nulls(cases_vacc, ["report_time"])
    j = dated.join(p, (F.col("report_time") == F.col("_p_day"))
                   & (F.col("state_name") == F.col("_p_region")), "left") \
        .drop("_p_day", "_p_region")
    return fills.impute_group_mean(j, ["state_name"], list(pollutants), method="window")


# --------------------------------------------------------------------------- T7

def country_by_day(combined: DataFrame, sums: Sequence[str] | None = None,
                   means: Sequence[str] = POLLUTANTS) -> DataFrame:
    """Country totals per day: sums of counts, means of pollutants."""
    sums = list(sums) if sums is not None else list(CASE_MEASURES) + list(DOSE_MEASURES)
    return agg.mixed_rollup(combined, ["report_time"], sums, list(means))


# --------------------------------------------------------------------------- T8

def closes_by_day(series: Mapping[str, DataFrame]) -> DataFrame:
    """Several index exports (``Date`` as ``dd MMM yyyy``, ``Close`` text)
    side by side per day; the first series decides the days (left joins).

    Column names are matched case-insensitively, as Spark resolves them.
    """
    parts = []
    for name, df in series.items():
        parts.append(df.select(dates.parse_day_text("Date").alias("Date"),
                               numbers.to_double(F.col("close")).alias(name)))
    return joins.align_series(parts, "Date")


# --------------------------------------------------------------------------- T9

def country_with_closes(country: DataFrame, closes: DataFrame,
                        close_cols: Sequence[str] = CLOSE_SERIES) -> DataFrame:
    """Country table with the day's closes, carried forward over days
    without a close (weekends, holidays) by the two-phase global fill.

    The fill reads its input twice (in-bucket fill and bucket edges); the
    joined table is one row per day, so it is handed off as a written table
    first and the long lineage behind it runs once."""
    j = joins.join_keys_renamed(country, closes, "report_time", "Date")
    return fills.fill_forward(j, list(close_cols), "report_time", materialize=True)


# --------------------------------------------------------------------------- hand-off

def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a stage output as Parquet under the shared checkpoint folder and
    read it back: cuts lineage for stages that several questions reuse, and
    survives executor loss (unlike a cache)."""
    from daybook.sources.sinks import handoff
    return handoff(df, name)
