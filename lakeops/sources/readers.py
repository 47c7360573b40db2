"""Parquet and JDBC readers (SRC-1..3, SRC-5..10)."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import as_time, conform, moment
from .schemas import SCHEMAS, Load, Policy


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet directory with Hive partition discovery; optionally the union of the columns
    of all its files."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_layer(spark: SparkSession, root: str, layer: str, table: str, **options) -> DataFrame:
    """Table of a named layer. A missing table is an error that names it."""
    path = f"{root}/{layer}/{table}"
    try:
        return read_table(spark, path, **options)
    except AnalysisException as error:
        raise FileNotFoundError(f"cannot read {layer}.{table} at {path}") from error


def read_typed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read with the registry's types and no inference."""
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def is_empty(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return df.isEmpty()


# Files of one table with different types ------------------------------------------------


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``path`` that hold data files, as Spark lists them: one entry per
    partition, not per file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = files.option("pathGlobFilter", "*.parquet").load(path).select("path")
    found = listed.select(F.regexp_replace("path", "/[^/]+$", "").alias("folder")).distinct()
    return sorted(r["folder"] for r in found.collect())


def read_drifting(spark: SparkSession, path: str, schema: T.StructType, workers: int = 16) -> DataFrame:
    """Scan a table whose partitions disagree on column types and land it on ``schema``.

    Spark refuses to merge, say, bigint with double ids. Each folder is opened by Spark's own
    reader, on any store it reaches; folders with the same types of the wanted columns become one
    scan of those columns, each scan is conformed and the scans are united. A folder whose own
    files disagree is read file by file. Columns outside ``schema`` are kept where all folders
    agree on their type.
    """

    def typed(place: str) -> tuple[str, T.StructType | None]:
        try:
            return place, spark.read.option("mergeSchema", "true").parquet(place).schema
        except (PySparkException, Py4JJavaError) as error:
            if "CANNOT_MERGE" in str(error):
                return place, None
            raise

    with ThreadPoolExecutor(max_workers=workers) as pool:
        known = list(pool.map(typed, folders(spark, path)))
        mixed = [place for place, kind in known if kind is None]
        if mixed:
            single = spark.read.format("binaryFile").load(mixed).select("path").filter("path LIKE '%.parquet'")
            known += list(pool.map(typed, sorted(r["path"] for r in single.collect())))
    known = [(place, kind) for place, kind in known if kind is not None]
    if not known:
        return spark.read.schema(schema).parquet(path)
    extra: dict[str, set[str]] = {}
    for _, kind in known:
        for f in kind.fields:
            if f.name not in schema.fieldNames():
                extra.setdefault(f.name, set()).add(f.dataType.json())
    alike = [name for name, kinds in extra.items() if len(kinds) == 1]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for place, kind in known:
        wanted = T.StructType([f for f in kind.fields if f.name in schema.fieldNames() or f.name in alike])
        groups.setdefault(wanted.json(), (wanted, []))[1].append(place)
    scans = [
        conform(spark.read.schema(wanted).option("basePath", path).parquet(*places), schema)
        for wanted, places in groups.values()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


# Incremental extraction ------------------------------------------------------------------


def effective_mark(policy: Policy, mark: dt.datetime | None, full: bool = False) -> dt.datetime | None:
    """Snapshot tables and forced reloads ignore the mark."""
    return None if full or policy.load is Load.SNAPSHOT or not policy.change_column else mark


def extract(
    source: DataFrame,
    policy: Policy,
    mark: dt.datetime | None = None,
    until: dt.datetime | None = None,
    full: bool = False,
) -> DataFrame:
    """Rows changed at or after the mark, optionally up to an upper bound (inclusive).

    Rows without a change time belong to every load: no mark tells whether they are new.
    """
    since = effective_mark(policy, mark, full)
    out = source
    if since:
        changed, kind = as_time(source, policy.change_column)
        out = source.filter((changed >= moment(since, kind)) | changed.isNull())
    if until is not None and policy.load is not Load.SNAPSHOT and policy.change_column:
        changed, kind = as_time(source, policy.change_column)
        upto = changed <= moment(until, kind)
        out = out.filter(upto | changed.isNull())
    return out


def jdbc_slices(column: str, since: dt.datetime, until: dt.datetime, slices: int) -> list[str]:
    """Disjoint predicates that cover [since, until]; one becomes one parallel read."""
    step = (until - since) / slices
    edges = [since + step * i for i in range(slices)] + [until]
    text = [f"TIMESTAMP '{e.isoformat(sep=' ', timespec='microseconds')}'" for e in edges]
    out = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(text, text[1:])]
    out[-1] = f"{column} >= {text[-2]} AND {column} <= {text[-1]}"
    return out


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    policy: Policy,
    mark: dt.datetime | None = None,
    until: dt.datetime | None = None,
    slices: int = 32,
    full: bool = False,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Extract from a database in parallel slices of the change column.

    Without a mark the table is read whole; its rows may have no change time at all, which
    a range over that column would lose.
    """
    since = effective_mark(policy, mark, full)
    if since is None or until is None:
        return extract(
            spark.read.jdbc(url, table, properties=properties or {}), policy, mark, until, full
        )
    predicates = jdbc_slices(policy.change_column, since, until, slices)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
