"""Arithmetic with the reference's NULL rules (Hive: x/0 is NULL, bad casts are NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_long(x) -> Column:
    """Number text as a bigint, fraction cut off toward zero (Hive: ``cast('123.7' as bigint)``
    is 123); text that is no number is NULL.  One decimal cast: decimal to bigint cuts toward zero."""
    return _c(x).cast("string").try_cast(DecimalType(38, 6)).try_cast("long")


def text_key(x) -> Column:
    """Number text compared with a bigint key: '7' and '7.0' are 7, '7.5' matches nothing.  Whole
    numbers, nearly all keys, are read by one integer cast; only other text is read as a decimal."""
    t = _c(x).cast("string")
    d = t.try_cast(DecimalType(38, 6))
    return F.coalesce(t.try_cast("long"), F.when(d == F.floor(d), d.try_cast("long")))


def money(x) -> Column:
    """Amounts as decimals: sums of doubles depend on task order, sums of decimals do not."""
    return _c(x).cast(DecimalType(20, 6))


def safe_div(num, den) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 or NULL (Hive rule)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round_half_up(x, digits: int) -> Column:
    """Round half-up on the decimal value, returned as double.

    Rounding a double directly differs between engines for values such as 1.005;
    going through a decimal makes the result the one a person computes by hand.
    """
    return F.round(_c(x).cast(DecimalType(38, 12)), digits).cast("double")


def decimal0(x) -> Column:
    """Half-up rounding to a whole number, as a bigint.  Hive's ``cast(x as decimal)`` is
    decimal(10,0) and turns larger values into NULL; they are kept here on purpose."""
    return F.round(_c(x).cast("double"), 0).cast("bigint")


def avg_positive(x) -> Column:
    """sum(x) / number of samples with x > 0, as decimal(10,0); 0 when there is none.

    Zero samples are left out of the denominator on purpose: a minute with nobody
    online must not drag the average down.
    """
    return F.coalesce(decimal0(safe_div(F.sum(_c(x)), F.count_if(_c(x) > 0))), F.lit(0).cast("bigint"))


def tier(x, bounds=(500, 5000, 50000), labels=("p0", "p1", "p2", "p3")) -> Column:
    """Spend tier: > bounds[i] gives labels[i+1]; NULL and the lowest band give labels[0]."""
    x = _c(x)
    out = F.when(x > bounds[-1], labels[-1])
    for b, lab in zip(bounds[-2::-1], labels[-2:0:-1]):
        out = out.when(x > b, lab)
    return out.otherwise(labels[0])
