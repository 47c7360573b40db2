"""Exact places of rows in a sorted table and in its groups, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

_UNIT_BITS = 52


def unit(*parts: Column) -> Column:
    """52 bits of an MD5 as a whole number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, _UNIT_BITS // 4), 16, 10).cast("bigint")


def fraction(*parts: Column) -> Column:
    """The same as a number inside (0, 1)."""
    return (unit(*parts).cast("double") + 0.5) / F.lit(float(1 << _UNIT_BITS))


def sorted_parts(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` sorted over all tasks, stored, with ``p`` (the range a row fell into, ascending) and ``i``
    (its place there, from 0).

    ``order`` should end with a column that no two rows share: then every range can be cut, however
    often a value repeats. ``rows`` are read twice, once to draw the ranges, so pass a stored table.
    """
    at = F.monotonically_increasing_id()  # the task's number, and in the low 33 bits the row's place in it
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at)
    parts = cut.withColumns({"p": F.shiftright("at", 33), "i": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
    return stored(parts.drop("at"), label)


def group_offsets(parts: DataFrame, group: str) -> DataFrame:
    """(group, p, first, before, size): where a group's rows start in each range, how many of them lie in
    earlier ranges, and how many there are in all. One row per group and range."""
    pieces = parts.groupBy(group, "p").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(group)
    before = F.sum("n").over(own.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    return pieces.select(group, "p", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(own).alias("size"))


def total_offsets(parts: DataFrame) -> DataFrame:
    """(p, before, size): the same over all rows. The window sees one row per range."""
    pieces = parts.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    return pieces.select("p", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy()).alias("size"))
