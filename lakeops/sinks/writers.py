"""Parquet writers and table registration (SNK-1..14)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import moment, month_text_to_date, to_long, to_timestamp, to_utc_naive
from ..functions.dates import partition_columns
from ..operators.dedup import row_hash
from ..operators.quality import quarantined_rows
from ..sources.paths import read_if_present
from ..sources.schemas import TIMESTAMP_COLUMNS

STALE_PARTITIONS = ("y", "m", "d")
MONTH_CUTS = 512  # parts that rows are dealt to by output partition; adaptive execution puts small ones together


def drop_partition_columns(df: DataFrame, names: Sequence[str] = STALE_PARTITIONS) -> DataFrame:
    """Remove partition columns inherited from the input; absent ones are ignored."""
    return df.drop(*names)


def with_partitions(df: DataFrame, date: str | Column, **names) -> DataFrame:
    """Drop stale partition columns and derive them again from a date."""
    column = F.col(date) if isinstance(date, str) else date
    return drop_partition_columns(df).withColumns(partition_columns(column, **names))


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of an output partition together before the write.

    Without this every task writes a small file into every month it holds. The rebalance
    leaves the task sizes to adaptive execution: small months share a task, and a month with
    a large share of all rows is split over as many tasks as its size calls for. It starts from
    ``MONTH_CUTS`` parts, whatever the session's reducers are: a part then seldom holds more than one
    month, rows reach the writer in long runs of one month, and its sort by month has little to do.
    """
    return df.hint("rebalance", MONTH_CUTS, *columns) if columns else df


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the whole table. ``path`` must not be among the inputs of ``df``: Spark
    deletes it before it reads."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_partitions(df: DataFrame, path: str, columns: Sequence[str] = ("y", "m")) -> None:
    """Add files to the months of the batch. Not idempotent; see ``versioned.upsert``."""
    gathered(df, columns).write.mode("append").partitionBy(*columns).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str] = ("y", "m")) -> None:
    """Replace only the partitions that occur in ``df``; the others keep their files."""
    (
        gathered(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def overwrite_all_partitions(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("y", "m"),
    laid_out: bool = False,
    counts: Mapping[str, Column] | None = None,
) -> dict:
    """Replace a partitioned table as a whole, so that a month without rows disappears. Rows that are
    ``laid_out`` come from tasks that hold few partitions each, and are written by those tasks. ``counts`` are
    aggregates over the written rows, taken by the tasks that write them and returned."""
    out = df if laid_out else gathered(df, columns)
    counted = Observation() if counts else None
    if counted:
        out = out.observe(counted, *[c.alias(n) for n, c in counts.items()])
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*columns)
        .parquet(path)
    )
    return counted.get if counted else {}


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("y", "m"),
    by: Sequence[str] = (),
    row_group_bytes: int = 32 * 1024 * 1024,
) -> None:
    """Monthly files that each hold one range of ``by``, sorted, in row groups of bounded size (SNK-8, SNK-12).

    Rows are dealt by ranges of (month, ``by``) and sorted there, so files and row groups of a month do not
    overlap in ``by`` and a reader of one entity skips all but a few of them by their statistics. ``by`` should
    go on to a day or a row id: then an entity with very many rows is cut over files as well. Ranges come from a
    sample, which reads ``df`` twice. Where a month column is a literal, the writer sorts once more by month alone:
    files still hold ranges, row groups do not.
    """
    order = [*columns, *by]
    # For text that may be NULL the writer would put in a sort of its own, by month alone; the name it gives
    # to missing values, put in here, reads back as NULL.
    text = [c for c in columns if dict(df.dtypes)[c] == "string"]
    named = df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in text})
    (
        named.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("parquet.block.size", row_group_bytes)
        .partitionBy(*columns)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table in buckets by entity, sorted by it. Tables with the same keys and bucket count join, and
    aggregate by these keys, where they lie: the fact is shuffled once, here, and by no later report (JON-1).

    An entity lives in one bucket, so a placeholder key that holds much of the fact makes one large bucket; keep
    such rows out (``joins.lookup_join`` takes them) or use enough buckets for the rest.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def write_layer(df: DataFrame, path: str, columns: Sequence[str] = ("anio", "mes")) -> None:
    """Generic cleaned-layer write: partitioned if the frame has the columns, flat if not."""
    if all(c in df.columns for c in columns):
        overwrite_all_partitions(df, path, columns)
    else:
        write_snapshot(df, path)


def append_quarantine(
    tagged: DataFrame, path: str, run_id: str, rule_set: str, once: bool = False
) -> None:
    """Add the rejected rows with their error codes, the run and the rule set.

    A run owns a folder and replaces it when it is repeated. With ``once``, a row that another
    run already put here under the same rules, all its values equal, is not added again.
    """
    spark = tagged.sparkSession
    rejected = quarantined_rows(tagged)
    rejected = rejected.withColumns(
        {"run_id": F.lit(run_id), "rule_set": F.lit(rule_set), "row_hash": row_hash(rejected)}
    )
    folder = re.sub(r"[^A-Za-z0-9._-]", "_", run_id)
    kind = "rule_set string, row_hash bigint, run string"
    known = read_if_present(spark, path, kind) if once else None
    if known is not None:
        known = known.filter(F.col("run") != folder).select("rule_set", "row_hash").distinct()
        rejected = rejected.join(known, ["rule_set", "row_hash"], "left_anti")
    rejected.write.mode("overwrite").parquet(f"{path}/run={folder}")


def bronze_partitions(df: DataFrame, run_ts: dt.datetime, change_column: str = "last_modified_at") -> DataFrame:
    """Raw partitions y/m/d from the change time; missing or unreadable times, and tables
    without that column, fall back to the run time."""
    fallback = F.lit(run_ts)
    if change_column in df.columns:
        kind = df.schema[change_column].dataType
        when = F.coalesce(to_timestamp(F.col(change_column), kind).cast("timestamp"), fallback)
    else:
        when = fallback
    return with_partitions(df, when)


def _kind(source: T.DataType) -> str:
    return "timestamp_ntz" if isinstance(source, T.TimestampNTZType) else "timestamp"


def relayout(
    df: DataFrame,
    technical_date: str,
    business_date: str | None = None,
    until: dt.datetime | None = None,
    daily: bool = False,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Re-derive raw partitions from the technical date (SNK-8).

    ``until`` drops rows whose business date is later or unknown. Rows without a technical
    date are dropped; a table that has no such column takes the run time.
    """
    out = drop_partition_columns(df, (*STALE_PARTITIONS, "ingest_date"))
    if until is not None and business_date:
        kind = out.schema[business_date].dataType
        when = to_timestamp(F.col(business_date), kind)
        out = out.filter(when <= moment(until, _kind(kind)))
    if technical_date in out.columns:
        when = to_timestamp(F.col(technical_date), out.schema[technical_date].dataType)
    else:
        when = F.lit(run_ts)
    columns = partition_columns(when, day="d" if daily else None)
    return out.withColumns(columns).dropna(subset=list(columns))


def hive_export(
    df: DataFrame,
    date: str,
    id_prefix: str = "id_",
    timestamps: Sequence[str] = TIMESTAMP_COLUMNS,
) -> DataFrame:
    """Typed upload layout: zone-free UTC timestamps, bigint ids, ``anio/mes/dia`` text
    partitions; rows without a date are skipped (SNK-9)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.withColumns(
        {c: to_utc_naive(F.col(c), types[c]) for c in timestamps if c in types}
        | {c: to_long(F.col(c)) for c in types if c.startswith(id_prefix)}
    )
    columns = partition_columns(F.col(date), "anio", "mes", "dia")
    return out.withColumns(columns).dropna(subset=list(columns))


def month_export(df: DataFrame, month_column: str = "anio_mes") -> DataFrame:
    """y/m/d columns of the curated export: first day of the ``yyyy-MM`` month (SNK-5)."""
    kind = dict(df.dtypes)[month_column]
    day = month_text_to_date(F.col(month_column)) if kind == "string" else F.col(month_column)
    return drop_partition_columns(df).withColumns(
        {"y": F.year(day), "m": F.month(day), "d": F.lit(1)}
    )


def write_export(df: DataFrame, path: str, month_column: str = "anio_mes", laid_out: bool = False) -> None:
    overwrite_all_partitions(month_export(df, month_column), path, STALE_PARTITIONS, laid_out)


def register_external(spark: SparkSession, name: str, path: str, partitioned: bool = True) -> None:
    """(Re)create an external table over a location and pick up its partitions (SNK-6).

    The schema, partition columns included, is inferred from the files.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)


def publish_marts(
    tables: Mapping[str, DataFrame], database: str, prefixes: Sequence[str] = ("feat_", "dashboard_")
) -> list[str]:
    """Truncate-and-load the published tables into a catalog database (SNK-11)."""
    chosen = [name for name in tables if name.startswith(tuple(prefixes))]
    for name in chosen:
        tables[name].write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
    return chosen


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Truncate-and-load into a database table, keeping its definition and grants."""
    df.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties or {})
