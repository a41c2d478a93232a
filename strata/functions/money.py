"""Exact money arithmetic.

Money columns are stored as DOUBLE, but totals are computed exactly: a total is
the exact sum of the inputs at four decimals (a rate of 0.055 is exact), so it
does not depend on partitioning or summation order and is the same in every
engine. A NaN input gives a NaN total, as a DOUBLE sum would.

Each value becomes an integer number of units: ``units(x)`` in 1e-4,
``net_units(price, discount)`` = price * (1 - discount) in 1e-8. ``sum_units``
sums them with 64-bit integer aggregates: every unit is split into a high part
(``u >> 20``) and a low part (``u & (2^20 - 1)``), both summed as BIGINT.
Neither partial sum can overflow below ~8.8e12 rows per group, so the hot loop
stays in long arithmetic inside whole-stage codegen; the two sums are combined
into an exact DECIMAL(38,0) once per group. A value too large for its units
(an amount of 9e10) fails rather than wraps.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: decimals of amounts, and of products of two
SCALE, NET_SCALE = 4, 8
_ONE = 10 ** SCALE
_SPLIT = 20
_LOW_MASK = (1 << _SPLIT) - 1


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(c: Column | str) -> Column:
    """Amount or rate in 1e-4 units (BIGINT), halves away from zero as a
    DECIMAL cast has them; NULL for NULL and NaN (see ``amount_sum``)."""
    x = _c(c) * _ONE
    return F.when(~F.isnan(x), F.when(x < 0, F.ceil(x - 0.5)).otherwise(F.floor(x + 0.5))).cast("long")


def net_units(price: Column | str, discount: Column | str) -> Column:
    """price * (1 - discount) in 1e-8 units (BIGINT, exact)."""
    return units(price) * (F.lit(_ONE) - units(discount))


def sum_units(u: Column) -> Column:
    """Exact SUM of a BIGINT column as DECIMAL(38,0) (an aggregate)."""
    hi = F.sum(F.shiftright(u, _SPLIT)).cast("decimal(38,0)")
    lo = F.sum(u.bitwiseAND(F.lit(_LOW_MASK))).cast("decimal(38,0)")
    return hi * F.lit(1 << _SPLIT) + lo


def to_amount(total: Column, scale: int) -> Column:
    """Unit total -> DOUBLE amount, one correctly rounded conversion."""
    return F.concat(total.cast("decimal(38,0)").cast("string"), F.lit(f"E-{scale}")).cast("double")


def any_nan(*inputs: Column | str) -> Column:
    """Whether a group has a NaN input (an aggregate)."""
    found = F.lit(False)
    for c in inputs:
        found = found | F.coalesce(F.isnan(_c(c)), F.lit(False))
    return F.max(found)


def _nan_or(inputs, value: Column) -> Column:
    return F.when(any_nan(*inputs), F.lit(float("nan"))).otherwise(value)


def amount_sum(c: Column | str) -> Column:
    """Exact SUM as DOUBLE (an aggregate)."""
    return _nan_or([c], to_amount(sum_units(units(c)), SCALE))


def net_sum(price: Column | str, discount: Column | str) -> Column:
    """Exact SUM of price * (1 - discount) as DOUBLE (an aggregate)."""
    return _nan_or([price, discount], to_amount(sum_units(net_units(price, discount)), NET_SCALE))


def amount_avg(c: Column | str) -> Column:
    """Exact AVG over the non-null rows as DOUBLE (an aggregate)."""
    return F.try_divide(amount_sum(c), F.count(_c(c)))
