"""Numeric column helpers.

Spark 4 runs with ANSI mode on, so every conversion of dirty text uses the
``try_`` family: bad input becomes null (and is counted by the caller) instead
of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grouped_digits(c) -> Column:
    """text with digit-group commas and blanks -> ``bigint``.

    Null, empty text and ``nan`` give 0.  Text that is still not an integer
    after removing commas and blanks (``123.0``, ``abc``) also gives 0; use
    :func:`grouped_digits_reject` to count those rows apart.
    """
    return F.coalesce(_parse_grouped(c), F.lit(0).cast("bigint"))


def grouped_digits_reject(c) -> Column:
    """True where :func:`grouped_digits` had to turn non-numeric text into 0."""
    stripped = _strip_grouping(c)
    missing = stripped.isNull() | (stripped == "") | (F.lower(stripped) == "nan")
    return (~missing) & stripped.try_cast("bigint").isNull()


def _strip_grouping(c) -> Column:
    # translate() deletes the listed characters; no regular expression per value
    return F.translate(_c(c).cast("string"), ", ", "")


def _parse_grouped(c) -> Column:
    return _strip_grouping(c).try_cast("bigint")


def sum_grouped(*cols) -> Column:
    """F16: row-wise sum of several F6-cleaned cells."""
    out = grouped_digits(cols[0])
    for c in cols[1:]:
        out = out + grouped_digits(c)
    return out


def to_double(c) -> Column:
    """text -> double, null for text such as ``-``."""
    return _c(c).try_cast("double")


def to_bigint(c) -> Column:
    """integer conversion of conformed (already valid) values."""
    return _c(c).cast("bigint")


def round_half_even(c, places: int = 2, snap: int | None = None) -> Column:
    """numpy-style rounding: scale, round half to even on the binary value, unscale.

    ``round``/``bround`` on doubles go through the decimal of the printed
    value and differ from numpy at ties; ``rint`` works on the scaled double
    itself, which is what numpy does.

    ``snap``: for computed means, first round the scaled value to ``snap``
    decimals.  A mean that is mathematically a tie (``x.xx5``) comes out a
    last bit above or below it depending on summation order, which changes
    from run to run in a distributed aggregate; snapping removes that noise so
    the rounded value is reproducible (ties then go to even).
    """
    scale = float(10 ** places)
    scaled = _c(c) * F.lit(scale)
    if snap is not None:
        scaled = F.round(scaled, snap)
    return F.rint(scaled) / F.lit(scale)


def sum0(c) -> Column:
    """Sum whose empty / all-null result is 0 (a pandas group sum), not null."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))
