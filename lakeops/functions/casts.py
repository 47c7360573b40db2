"""Tolerant type conversion: bad input becomes NULL, never an error (CST-1..6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS_ONLY = r"^\d+$"


def to_long(col: Column) -> Column:
    """Any scalar to bigint. ``'12.0'`` and 12.0 give 12; NaN and text give NULL.

    The direct cast is tried first so that ids above 2**53 keep all their digits.
    """
    return F.coalesce(col.try_cast("long"), col.try_cast("double").try_cast("long"))


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_int(col: Column) -> Column:
    return F.coalesce(col.try_cast("int"), col.try_cast("double").try_cast("int"))


def text_to_timestamp(col: Column) -> Column:
    """Text holding either ISO-8601 or epoch microseconds to timestamp."""
    text = F.trim(col)
    return F.when(
        text.rlike(DIGITS_ONLY), F.timestamp_micros(text.try_cast("long"))
    ).otherwise(F.try_to_timestamp(text))


def to_timestamp(col: Column, source: T.DataType) -> Column:
    """Timestamp from whatever the source type is.

    Columns that already are timestamps come back untouched, so comparisons on them are
    still pushed into the Parquet scan.
    """
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return col
    if isinstance(source, T.StringType):
        return text_to_timestamp(col)
    if isinstance(source, T.IntegralType):
        return F.timestamp_micros(col.cast("long"))
    if isinstance(source, T.FractionalType):
        return F.timestamp_micros(to_long(col))
    return col.try_cast("timestamp")


def to_utc_naive(col: Column, source: T.DataType) -> Column:
    """Instant to zone-free UTC timestamp with microsecond precision."""
    if isinstance(source, T.TimestampNTZType):
        return col
    instant = to_timestamp(col, source)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def moment(value: dt.datetime, kind: str) -> Column:
    """Literal of a naive UTC time for a column of type ``kind``, in any session zone."""
    text = value.isoformat(sep=" ")
    return F.lit(f"{text}Z" if kind == "timestamp" else text).cast(kind)


def as_time(df: DataFrame, column: str) -> tuple[Column, str]:
    """A change-time column as something a ``moment`` compares with, and its kind.

    Typed columns come back bare (the scan can use the comparison), text is parsed.
    """
    source = df.schema[column].dataType
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column), source.simpleString()
    return to_timestamp(F.col(column), source), "timestamp"


def month_text_to_date(col: Column) -> Column:
    """``'yyyy-MM'`` to the first day of that month."""
    return F.try_to_date(col, "yyyy-MM")


def cast_column(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Tolerant conversion of one column to a registry type; NaN becomes NULL."""
    if isinstance(target, T.TimestampType):
        return to_timestamp(col, source)
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return F.nullif(col if source == target else col.try_cast(target), F.lit(float("nan")).cast(target))
    if source == target:
        return col
    if isinstance(target, T.LongType):
        return to_long(col)
    if isinstance(target, T.IntegerType):
        return to_int(col)
    return col.try_cast(target)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """Land a frame on a target schema in one projection.

    Columns missing from the frame are added as typed NULLs; columns not in the schema are
    kept unless ``keep_extra`` is false.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    out = [
        (
            cast_column(F.col(f.name), present[f.name], f.dataType)
            if f.name in present
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in schema.fields
    ]
    if keep_extra:
        wanted = set(schema.fieldNames())
        out += [F.col(c) for c in df.columns if c not in wanted]
    return df.select(*out)
