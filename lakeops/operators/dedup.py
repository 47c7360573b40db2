"""Latest row per key and duplicate detection (DDP-1..3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hash of values and NULL flags, so that (NULL, 5) and (5, NULL) differ.

    Nested values are hashed as JSON with their NULLs; maps, which cannot be hashed, as well.
    """
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    parts = []
    for field in df.schema.fields:
        if columns is None or field.name in columns:
            column = F.col(f"`{field.name}`")
            parts.append(column.isNull())
            if isinstance(field.dataType, nested):
                column = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
            parts.append(column)
    return F.xxhash64(*parts)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row of every key, newest by ``order`` descending, NULLs last.

    Ties are settled by ``tie_breakers`` (descending); with ``order`` they should tell any two
    rows apart that differ in a column the caller reads. Without them a hash over the values and
    the NULL flags of all columns settles ties, so the same input always gives the same survivor,
    at the price of reading every column. All NULL keys form one group.

    ``row_number() = 1`` makes the optimizer put a group limit in front of the shuffle: a
    map task sends at most one row per key, so a key that holds most of the table costs one
    row per map task on the reduce side.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in (*order, *(tie_breakers or ()))]
    if tie_breakers is None:
        newest_first.append(row_hash(df).desc())
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def latest_by_first_available(
    df: DataFrame,
    keys: Sequence[str],
    candidates: Sequence[str] = ("last_modified_at", "created_at"),
) -> DataFrame:
    """Latest row by the first candidate column the frame has; unchanged if it has none."""
    order = next((c for c in candidates if c in df.columns), None)
    return df if order is None else latest_by_key(df, keys, [order])


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "count") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)
