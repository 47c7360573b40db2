"""Per-entity aggregates on every row, and running or trailing totals (WIN-2..5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import units
from .joins import HOT_ROWS, lookup_join


def per_entity(
    df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """One row per entity with its metrics, and the same rows for the most frequent ones.

    Both frames come from one aggregation and share its shuffle. The filter drops nothing; it
    keeps the row count in both plans, which makes their aggregations identical.
    """
    grouped = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"), *[m.alias(name) for name, m in metrics.items()])
        .filter("__rows > 0")
    )
    return with_hot(grouped, keys, "__rows")


def with_hot(grouped: DataFrame, keys: Sequence[str], rows: str) -> tuple[DataFrame, DataFrame]:
    """Per-entity rows without their row count ``rows``, and those of the most frequent entities."""
    hot = grouped.orderBy(F.desc(rows), *keys).limit(HOT_ROWS).drop(rows)
    return grouped.drop(rows), hot


def entity_metrics(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, Column],
    salt: Sequence[str] = (),
) -> DataFrame:
    """Repeat whole-entity aggregates on each of the entity's rows.

    Same values as aggregates over ``Window.partitionBy(keys)``, which would gather every
    entity in one task. Here the aggregates are combined on the map side and joined back, so
    an entity of any size stays spread out. ``salt`` names a row id for that, see ``lookup_join``.
    """
    grouped, hot = per_entity(df, keys, metrics)
    return lookup_join(df, grouped, keys, hot=hot, null_safe=True, salt=salt)


def _over(value: Column, window, scale: int | None) -> Column:
    if scale is None:
        return F.sum(value).over(window)
    return F.sum(units(value, scale)).over(window) / F.lit(float(10**scale))


def running_total(value: Column, order: str, scale: int | None = None) -> Column:
    """Total from the first row to the current one.

    Unpartitioned, hence one task: only for inputs already reduced to one row per month.
    """
    window = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _over(value, window, scale)


def trailing_total(value: Column, order: str, rows: int = 3, scale: int | None = None) -> Column:
    """Total of the current and the previous ``rows - 1`` rows. Rows, not calendar months:
    a month without any row is not padded. One task, like ``running_total``."""
    return _over(value, Window.orderBy(order).rowsBetween(1 - rows, Window.currentRow), scale)
