"""Calendar attributes and ages. The reference day is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | dt.datetime | Column | None


def as_of_day(as_of: AsOf) -> Column:
    """Reference day as a column; the current date when none was given."""
    if as_of is None:
        return F.current_date()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")


def as_of_instant(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def month_key(col: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(col, "yyyy-MM")


def days_since(col: Column, as_of: AsOf) -> Column:
    return F.datediff(as_of_day(as_of), col)


def months_since(col: Column, as_of: AsOf) -> Column:
    """Months with a 31-day fraction; whole between equal days and between month ends."""
    return F.months_between(as_of_day(as_of), col)


def partition_columns(
    date_col: Column, year: str = "y", month: str = "m", day: str | None = "d"
) -> dict[str, Column]:
    """Year as int, month and day as two-digit text (SNK-14)."""
    out = {year: F.year(date_col), month: two_digits(F.month(date_col))}
    if day:
        out[day] = two_digits(F.dayofmonth(date_col))
    return out
