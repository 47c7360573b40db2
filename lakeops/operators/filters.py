"""Row filters that reach the scan (FLT-*, INC-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_time, moment


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    """First day of a ``YYYY-MM`` month and of the month after it."""
    first = dt.date.fromisoformat(f"{month}-01")
    return first, (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def month_slice(df: DataFrame, column: str, month: str | None) -> DataFrame:
    """Rows of one month as a half-open range on the bare column, so that Parquet statistics
    can skip row groups. ``None`` keeps everything."""
    if not month:
        return df
    first, after = month_bounds(month)
    kind = dict(df.dtypes)[column]
    low, high = (F.lit(d).cast(kind) for d in (first, after))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def partition_month_slice(
    df: DataFrame, month: str | None, year_col: str = "y", month_col: str = "m"
) -> DataFrame:
    """The same on partition columns: only that directory is listed and read."""
    if not month:
        return df
    first, _ = month_bounds(month)
    month_value = first.month if dict(df.dtypes)[month_col] != "string" else f"{first.month:02d}"
    return df.filter((F.col(year_col) == first.year) & (F.col(month_col) == month_value))


def after_mark(
    df: DataFrame, column: str, mark: dt.datetime | None, inclusive: bool = False
) -> DataFrame:
    """Rows changed after a high-water mark; everything when there is no mark.

    On a typed column the mark takes the column's type and not the other way round, which
    keeps the comparison eligible for push-down.
    """
    if mark is None:
        return df
    changed, kind = as_time(df, column)
    bound = moment(mark, kind)
    return df.filter(changed >= bound if inclusive else changed > bound)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where any of the columns is NULL."""
    return df.dropna(subset=list(columns))


def positive_and_dated(df: DataFrame, amount: str, date: str) -> DataFrame:
    return df.filter((F.col(amount) > 0) & F.col(date).isNotNull())


def in_status(column: str, *labels: str) -> Column:
    return F.col(column).isin(*labels) if len(labels) > 1 else F.col(column) == labels[0]
