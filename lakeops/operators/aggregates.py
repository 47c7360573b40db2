"""Group-by shapes shared by the feature tables (AGG-1..9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import mean, total, units


def amount_stats(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    row_id: str,
    names: Mapping[str, str],
    date: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Amount statistics per key.

    ``names`` picks the statistics and names them: ``total``, ``count``, ``mean``, ``max``,
    ``min`` of the amount and ``first`` / ``last`` of the date. Every one is a partial
    aggregate, so a frequent key is combined on the map side.
    """
    a = F.col(amount)
    shapes = {
        "total": lambda: total(a, scale),
        "count": lambda: F.count(row_id),
        "mean": lambda: mean(a, scale),
        "max": lambda: F.max(a),
        "min": lambda: F.min(a),
        "first": lambda: F.min(date),
        "last": lambda: F.max(date),
    }
    return df.groupBy(*keys).agg(*[shapes[s]().alias(name) for s, name in names.items()])


def amount_partials(
    df: DataFrame, keys: Sequence[str], amount: str, row_id: str, date: str, scale: int | None = None
) -> DataFrame:
    """Per key what any statistic of ``amount_stats`` can be put together from, however often merged.

    Keyed by entity and month, the rows of a month can be thrown away and made again without looking at
    other months; minima and maxima then follow as well, which no difference of old and new could give.
    """
    a = F.col(amount)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(row_id).alias("ids"),
        F.count(a).alias("amounts"),
        F.sum(a if scale is None else units(a, scale)).alias("sum"),
        F.min(a).alias("low"),
        F.max(a).alias("high"),
        F.min(date).alias("first"),
        F.max(date).alias("last"),
    )


def merged_stats(
    partials: DataFrame, keys: Sequence[str], names: Mapping[str, str], scale: int | None = None
) -> DataFrame:
    """The statistics of ``amount_stats`` from ``amount_partials``; ``rows`` is one more of them. With a
    ``scale`` both give the same values bit for bit."""
    whole = F.sum("sum") if scale is None else F.sum("sum") / F.lit(float(10**scale))
    shapes = {
        "total": whole,
        "count": F.sum("ids"),
        "mean": F.try_divide(whole, F.sum("amounts")),
        "max": F.max("high"),
        "min": F.min("low"),
        "first": F.min("first"),
        "last": F.max("last"),
        "rows": F.sum("rows"),
    }
    return partials.groupBy(*keys).agg(*[shapes[s].alias(name) for s, name in names.items()])


def distinct_bitmaps(df: DataFrame, by: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(by..., id_name, bucket, bits): which ids occur in each group, as bitmaps of 32,768 ids each (AGG-6).

    Bitmaps of finer groups merge into those of coarser ones (``bitmap_counts``), so months kept this way give
    exact distinct counts of any longer time without their rows. Each id column is combined on the map side
    by itself; rows are not copied per column. For whole-number ids that lie close together: every
    bucket that is used takes 4 KB, so ids drawn at random from 64 bits belong in ``count_distinct``.
    """
    parts = [
        df.filter(F.col(c).isNotNull())
        .groupBy(*by, F.lit(c).alias("id_name"), F.bitmap_bucket_number(c).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("bits"))
        for c in ids
    ]
    return reduce(DataFrame.unionByName, parts)


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts per group from ``distinct_bitmaps`` of the same or finer groups; ``names`` maps
    id columns to the names of their counts."""
    merged = bitmaps.groupBy(*by, "id_name", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    count = lambda c: F.coalesce(F.sum(F.when(F.col("id_name") == c, F.col("n"))), F.lit(0)).cast("long")
    return merged.groupBy(*by).agg(*[count(c).alias(name) for c, name in names.items()])


def amount_where(condition: Column, amount: Column, scale: int | None = None) -> Column:
    """Sum of the amount over rows where the condition is TRUE, 0 elsewhere."""
    return total(F.when(condition, amount).otherwise(F.lit(0.0)), scale)


def monthly_rollup(
    df: DataFrame,
    date: str,
    amount: str,
    row_id: str,
    scale: int | None = None,
    names: Sequence[str] = ("total_donaciones", "cantidad_donaciones", "promedio_donacion"),
) -> DataFrame:
    """Total, count and mean by calendar year and month, in calendar order (AGG-7, SRT-1)."""
    sum_name, count_name, mean_name = names
    return (
        df.groupBy(F.year(date).alias("anio"), F.month(date).alias("mes"))
        .agg(
            total(F.col(amount), scale).alias(sum_name),
            F.count(row_id).alias(count_name),
            mean(F.col(amount), scale).alias(mean_name),
        )
        .orderBy("anio", "mes")
    )
