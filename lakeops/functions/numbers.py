"""Sums, means and ratios.

Money arrives as double, so plain sums depend on the order in which partitions are merged.
With ``scale`` the value is summed as a whole number of 10**-scale units: exact, order-free,
and still a primitive long in the aggregation buffer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(col: Column, scale: int) -> Column:
    """Whole units, halves away from zero; NULL for NaN, infinity and amounts beyond a long.

    The same as ``F.round``, which makes a decimal of every double. What the whole part leaves of a double is
    exact, so a half is told from what is just below one.
    """
    value = col * F.lit(float(10**scale))
    whole = value.try_cast("long")
    rest = value - whole
    return whole + F.when(rest >= 0.5, F.lit(1)).when(rest <= -0.5, F.lit(-1)).otherwise(F.lit(0))


def total(col: Column, scale: int | None = None) -> Column:
    if scale is None:
        return F.sum(col)
    return F.sum(units(col, scale)) / F.lit(float(10**scale))


def mean(col: Column, scale: int | None = None) -> Column:
    """Mean of the non-NULL values, NULL when there are none."""
    if scale is None:
        return F.avg(col)
    return F.try_divide(total(col, scale), F.count(col))


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    """a / b when b is positive, else 0.0 (also for a NULL divisor)."""
    return F.when(b > 0, ratio(a, b)).otherwise(F.lit(0.0))


def percentage(a: Column, b: Column) -> Column:
    return F.when(b > 0, ratio(a * F.lit(100), b)).otherwise(F.lit(0.0))


def log_amount(col: Column) -> Column:
    """ln(1 + x); NULL at or below -1."""
    return F.log1p(col)
