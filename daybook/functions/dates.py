"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day_text(c, fmt: str = "dd MMM yyyy") -> Column:
    """text such as ``02 Jan 2020`` -> ``date``; null for text that does not parse."""
    return F.try_to_date(_c(c), fmt)


def render_day(c, fmt: str = "yyyy-MM-dd") -> Column:
    """``date`` -> text."""
    return F.date_format(_c(c), fmt)


def day_of(c) -> Column:
    """timestamp (or timestamp text) -> day, in the session time zone (UTC)."""
    return _c(c).try_cast("date")


def quarter_label(c) -> Column:
    """``2020Q1`` style label of a date."""
    d = _c(c)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def month_bucket(c) -> Column:
    """First day of the month: the default time bucket of the two-phase fills."""
    return F.trunc(_c(c).try_cast("date"), "month")
