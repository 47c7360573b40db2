"""High-water marks per table (INC-1, INC-2, INC-4..6).

The state is an append-only log of ``(table_name, mark, updated_at)``: setting a mark is one
atomic file append, reading it takes the latest entry. Six tables a week make a log of a few
hundred rows a year.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import as_time
from ..operators.dedup import latest_by_key
from ..sources.paths import read_if_present

_EPOCH = dt.datetime(1970, 1, 1)
_SCHEMA = "table_name string, mark timestamp, updated_at timestamp"


def parse_mark(text: str | dt.datetime | dt.date) -> dt.datetime:
    """ISO text (``Z`` and offsets allowed), date or datetime to naive UTC."""
    if isinstance(text, str):
        text = dt.datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    if not isinstance(text, dt.datetime):
        text = dt.datetime.combine(text, dt.time())
    return text.astimezone(dt.timezone.utc).replace(tzinfo=None) if text.tzinfo else text


def current_marks(spark: SparkSession, state: str) -> DataFrame:
    """One row per table that has a mark; empty before the first run.

    An unreadable log file is skipped: an older mark, or none, only means reading more again.
    """
    log = read_if_present(spark, state, _SCHEMA, ignoreCorruptFiles="true")
    if log is None:
        return spark.createDataFrame([], _SCHEMA)
    return latest_by_key(log, ["table_name"], ["updated_at"], ["mark"])


def get_mark(spark: SparkSession, state: str, table: str) -> dt.datetime | None:
    row = (
        current_marks(spark, state)
        .filter(F.col("table_name") == table)
        .select(F.unix_micros("mark"))
        .first()
    )
    return _EPOCH + dt.timedelta(microseconds=row[0]) if row else None


def set_marks(
    spark: SparkSession, state: str, marks: DataFrame, updated_at: dt.datetime | None = None
) -> None:
    """Append ``(table_name, mark)`` rows. Call it last, after all writes succeeded."""
    stamp = F.lit(updated_at) if updated_at else F.current_timestamp()
    (
        marks.select("table_name", F.col("mark").cast("timestamp"), stamp.alias("updated_at"))
        .coalesce(1)
        .write.mode("append")
        .parquet(state)
    )


def set_mark(
    spark: SparkSession, state: str, table: str, mark, updated_at: dt.datetime | None = None
) -> None:
    """Set or reset one mark by hand."""
    set_all(spark, state, [table], mark, updated_at)


def set_all(
    spark: SparkSession,
    state: str,
    tables: Iterable[str],
    mark,
    updated_at: dt.datetime | None = None,
) -> None:
    """The same mark for several tables in one append."""
    text = parse_mark(mark).isoformat(sep=" ") + "Z"
    rows = spark.createDataFrame([(t, text) for t in tables], "table_name string, mark string")
    set_marks(spark, state, rows, updated_at)


def newest_change(df: DataFrame, change_column: str) -> Column:
    """Newest change time of the rows as an aggregate: microseconds since 1970 in UTC."""
    changed, kind = as_time(df, change_column)
    newest = F.max(changed)
    if kind == "timestamp_ntz":  # zone-free times are UTC
        newest = F.concat(newest.cast("string"), F.lit("Z"))
    return F.unix_micros(newest.cast("timestamp"))


def from_micros(micros: int | None) -> dt.datetime | None:
    return None if micros is None else _EPOCH + dt.timedelta(microseconds=micros)


def latest_change(df: DataFrame, change_column: str) -> dt.datetime | None:
    """Newest change time of a frame as naive UTC, or None when it has none."""
    return from_micros(df.agg(newest_change(df, change_column)).first()[0])
