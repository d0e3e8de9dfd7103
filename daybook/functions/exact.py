"""Sums and means of doubles that do not depend on the order of rows.

A double is cut, without error, into whole multiples of powers of 2^24; the
parts are summed as integers, which partial aggregates may merge in any order,
and put together at the end, from the highest part down.  Any partitioning of
the same rows gives the same bits, which a plain sum of doubles does not; the
only rounding is that of the few last additions.

Bits below ``2^(24 LOW)`` (about 2e-22) are left out, in the same way for every
order.  Values of 2^96 and more, infinities and NaN are added as plain doubles.
A group may hold up to 2^39 rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Width of a part in bits; the lowest and highest power of 2^WIDTH with a part.
WIDTH, LOW, HIGH = 24, -3, 3


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _wild(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) >= F.lit(2.0 ** (WIDTH * (HIGH + 1))))


def _parts(x: Column) -> list[Column]:
    """Integers p with ``x = sum of p[i] * 2^(WIDTH (LOW + i))``, each under 2^WIDTH."""
    out, above = [], F.lit(0.0)
    for k in range(HIGH, LOW - 1, -1):
        here = _whole(x * F.lit(2.0 ** (-WIDTH * k)))
        out.append((here - above * F.lit(2.0 ** WIDTH)).cast("bigint"))
        above = here
    return out[::-1]


def _whole(x: Column) -> Column:
    """The whole part of a double as a double, of any size (``floor`` gives a bigint)."""
    near = F.rint(F.abs(x))
    return F.signum(x) * (near - F.when(near > F.abs(x), 1.0).otherwise(0.0))


def exact_sum(c) -> Column:
    """Sum of a double column (an aggregate); null for no value."""
    x = _c(c).cast("double")
    tame = F.when(~_wild(x), x)
    total = F.lit(0.0)
    for k, part in reversed(list(zip(range(LOW, HIGH + 1), _parts(tame)))):
        total = total + F.coalesce(F.sum(part), F.lit(0)).cast("double") * F.lit(2.0 ** (WIDTH * k))
    wild = F.sum(F.when(_wild(x), x))
    return F.when(F.count(x) > 0, total + F.coalesce(wild, F.lit(0.0)))


def exact_mean(c) -> Column:
    """Mean of the values that are not null (an aggregate); null for none."""
    return exact_sum(c) / F.nullif(F.count(_c(c)), F.lit(0))
