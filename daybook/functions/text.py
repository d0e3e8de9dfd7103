"""String column helpers.

All helpers take and return ``Column`` objects built from Spark built-ins, so
they stay inside whole-stage codegen and are null-safe: a null input gives a
null output instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix(c, n: int = 10) -> Column:
    """first ``n`` characters (a timestamp text cut to its day)."""
    return F.substring(_c(c), 1, n)


def code_suffix(c, start: int = 4) -> Column:
    """lower-case and keep the text from character ``start`` on (``IN-KL`` -> ``kl``)."""
    return F.substr(F.lower(_c(c)), F.lit(start))


def split_part(c, index: int, sep: str = " ") -> Column:
    """1-based ``index``-th part of ``c`` split on the literal ``sep``; null if absent."""
    return F.try_element_at(F.split(_c(c), _regex_literal(sep)), F.lit(index))


def join_blank(a, b) -> Column:
    """``a + ' ' + b``, null when either side is null (unlike ``concat_ws``)."""
    return F.concat(_c(a), F.lit(" "), _c(b))


def strip_digits(c) -> Column:
    """remove every run of digits."""
    return F.regexp_replace(_c(c), r"\d+", "")


def station_city(label) -> Column:
    """city part of a station label.

    With both ``-`` and ``,`` present: the next-to-last ``-`` part, then its
    last ``,`` part, trimmed.  Otherwise the label unchanged (not trimmed).
    """
    lab = _c(label)
    dash_parts = F.split(lab, "-")
    before_last = F.try_element_at(dash_parts, F.lit(-2))
    city = F.trim(F.try_element_at(F.split(before_last, ","), F.lit(-1)))
    has_both = (F.instr(lab, "-") > 0) & (F.instr(lab, ",") > 0)
    return F.when(has_both, city).otherwise(lab)


def station_board(label) -> Column:
    """F8: second ``-`` part trimmed (``A - B - C`` -> ``B``), else the trimmed label."""
    lab = _c(label)
    second = F.trim(F.try_element_at(F.split(lab, "-"), F.lit(2)))
    return F.when(F.instr(lab, "-") > 0, second).otherwise(F.trim(lab))


def two_line_head(c) -> Column:
    """F17 (first part): text before the first ``\\r(``."""
    return F.try_element_at(F.split(_c(c), r"\r\("), F.lit(1))


def two_line_tail(c) -> Column:
    """F17 (second part): first blank-separated token after ``\\r(``, else null."""
    after = F.try_element_at(F.split(_c(c), r"\r\("), F.lit(2))
    return F.try_element_at(F.split(after, " "), F.lit(1))


def first_token_tail(c) -> Column:
    """first blank-separated token without its first character."""
    return F.substr(F.try_element_at(F.split(_c(c), " "), F.lit(1)), F.lit(2))


def recode(c, mapping: dict) -> Column:
    """Replace exact values by others, leave the rest."""
    col = _c(c)
    out = None
    for old, new in mapping.items():
        out = (F.when(col == F.lit(old), F.lit(new)) if out is None
               else out.when(col == F.lit(old), F.lit(new)))
    return col if out is None else out.otherwise(col)


def _regex_literal(sep: str) -> str:
    special = set(r"\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)
