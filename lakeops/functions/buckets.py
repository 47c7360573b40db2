"""Ordered threshold buckets and flags (BKT-1..13).

A comparison with NULL is not TRUE, so a NULL amount always reaches ``otherwise`` and a
NULL flag is false. That is part of the contract, not an accident.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (comparison, bound(s), label); comparison is one of < <= > >= between
Band = tuple[str, object, str]


def _test(col: Column, op: str, bound) -> Column:
    if op == "between":
        low, high = bound
        return col.between(low, high)
    return {
        "<": col < bound,
        "<=": col <= bound,
        ">": col > bound,
        ">=": col >= bound,
    }[op]


def bucket(col: Column, bands: Sequence[Band], otherwise: str) -> Column:
    """Label of the first band the value falls in."""
    expr = F
    for op, bound, label in bands:
        expr = expr.when(_test(col, op, bound), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """Condition as a two-valued boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def exceeds(amount: Column, limit: Column) -> Column:
    """Three-valued flag: NULL while the limit is unknown, else ``amount > limit``."""
    return F.when(limit.isNotNull(), flag(amount > limit))
