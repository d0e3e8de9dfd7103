"""The five analysis questions as chart-ready DataFrames.

The reference draws charts from driver-side copies; here each question is the
aggregated table a chart would plot, computed on the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import quarter_label
from daybook.operators import aggregates as agg
from daybook.operators.reshape import unpivot_long
from daybook.plans.stages import CLOSE_SERIES


def index_performance(closes: DataFrame, series: Sequence[str] = CLOSE_SERIES) -> DataFrame:
    """Every close in long form with its quarter label."""
    long = unpivot_long(closes, ["Date"], list(series), "variable", "value")
    return long.withColumn("quarter", quarter_label("Date"))


def index_quarterly(closes: DataFrame, series: Sequence[str] = CLOSE_SERIES) -> DataFrame:
    """N1 (by quarter): mean close per series and quarter, the same bits in every run."""
    long = index_performance(closes, series)
    return agg.group_mean(long, ["quarter", "variable"], ["value"], ["mean_close"], exact=True)


def measure_over_time(combined: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The plotted points: day, quarter, region and the measures."""
    return combined.select("report_time", quarter_label("report_time").alias("quarter"),
                           "state_name", *measures)


def doses_and_cases(combined: DataFrame, doses: str = "total_doses",
                    cases: str = "confirmed") -> DataFrame:
    """Per-day means of doses and of cases (what the line chart estimates)."""
    return agg.mean_per_x(combined, "report_time", [doses, cases]) \
        .withColumnRenamed(doses, f"mean_{doses}").withColumnRenamed(cases, f"mean_{cases}")


def deaths_per_quarter(combined: DataFrame, deaths: str = "death") -> DataFrame:
    """Mean deaths per quarter label."""
    q = combined.select(quarter_label("report_time").alias("quarter"), deaths)
    return agg.group_mean(q, ["quarter"], [deaths], [f"mean_{deaths}"])


def region_totals(cases: DataFrame, deaths: str = "death") -> DataFrame:
    """N5 (ranking): deaths per region, most first (regions without a name dropped)."""
    tot = agg.group_sum(cases, ["state_name"], [deaths])
    return tot.orderBy(F.col(deaths).desc(), F.col("state_name"))


def region_extremes(cases: DataFrame, deaths: str = "death") -> DataFrame:
    """Region with the most and with the fewest deaths, with the totals."""
    tot = agg.group_sum(cases, ["state_name"], [deaths])
    return agg.arg_extremes(tot, "state_name", deaths)
