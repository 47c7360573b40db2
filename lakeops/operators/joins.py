"""Left joins of a large fact to lookups with one row per key (JON-1..5).

Every lookup here is unique on its key, so the joins never change the number of fact rows.
The danger at scale is the fact side: a placeholder key ("no donor given") can hold a large
share of all rows, and a shuffled join would send them all to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a lookup that are ever broadcast as "hot". A fixed number, so the broadcast cannot
# grow with the data; a key outside the list holds less than 1/HOT_ROWS of the fact.
HOT_ROWS = 4096
# Salts of a hot row; many more than reducers, so its key reaches all of them.
SPREAD = 2**20


def _matching(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    """Equality of two key lists whose names differ, so plain names are unambiguous."""
    tests = [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs
    ]
    return reduce(lambda x, y: x & y, tests)


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> tuple[list[Column], list[tuple[str, str]]]:
    names = [f"{prefix}{k}" for k in keys]
    return [F.col(k).alias(n) for k, n in zip(keys, names)], list(zip(keys, names))


def hottest_keys(fact: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """The ``rows`` most frequent keys: partial counts, then a top-k."""
    return (
        fact.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.desc("__n"), *keys)
        .limit(rows)
        .select(*keys)
    )


def hot_rows(fact: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lookup rows of the fact's most frequent keys: at most ``HOT_ROWS``."""
    key_cols, pairs = _renamed(fact, keys, "__f_")
    frequent = F.broadcast(hottest_keys(fact, keys).select(*key_cols))
    return lookup.join(frequent, _matching(pairs, True), "left_semi")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | str | Sequence | None = None,
    null_safe: bool = False,
    salt: Sequence[str] = (),
) -> DataFrame:
    """Left join ``fact`` to a lookup that has one row per key.

    ``hot`` controls what happens to frequent keys:

    * ``None`` - plain join: the optimizer broadcasts a small lookup, and the adaptive skew join
      splits what turns out large.
    * a list - placeholder values of a single key ("no donor given") that are known to be
      frequent. Nothing is counted; their lookup rows, one each, are broadcast.
    * ``"measure"`` - count the fact's keys first (reads only the key columns).
    * a frame - the result of ``hot_rows`` or of another count the caller already has. In a
      chain of lookups, measure on the bare fact, not on the joined one.

    Rows of a hot key find their partner in a broadcast of those few rows. They then go
    through the shuffled join under a salted key that matches nothing, which spreads them
    evenly; all other rows join on salt 0. Each fact row is read once and no row is lost.
    ``salt`` names the columns whose hash spreads hot rows, a row id at best; without it all
    columns of the fact do, and all are read.
    """
    values = [c for c in lookup.columns if c not in keys]
    if hot is None:
        key_cols, pairs = _renamed(lookup, keys, "__r_")
        right = lookup.select(*key_cols, *values)
        return fact.join(right, _matching(pairs, null_safe), "left").select(*fact.columns, *values)
    if isinstance(hot, str):
        if hot != "measure":
            raise ValueError(f"unknown hot-key mode {hot!r}")
        hot = hot_rows(fact, lookup, keys)
    elif not isinstance(hot, DataFrame):
        (key,) = keys
        hot = lookup.filter(F.col(key).isin(list(hot)))

    key_cols, pairs = _renamed(hot, keys, "__hot_")
    hot_side = F.broadcast(
        hot.select(*key_cols, F.struct(F.lit(1).alias("__found"), *values).alias("__hot"))
    )
    spread = F.col("__hot").isNotNull()
    if not null_safe:  # a NULL key finds no partner anywhere, so it may go anywhere
        spread = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys], spread)
    salted = fact.join(hot_side, _matching(pairs, null_safe), "left").withColumn(
        "__salt",
        F.when(spread, F.pmod(F.xxhash64(*(salt or fact.columns)), F.lit(SPREAD)) + 1)
        .otherwise(F.lit(0))
        .cast("int"),
    )

    # Always 0, but not a literal: the optimizer would turn a literal into a plain condition
    # on the fact and shuffle by the bare key again.
    zero = F.coalesce(F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int"), F.lit(0))
    key_cols, pairs = _renamed(lookup, keys, "__cold_")
    cold = lookup.select(
        *key_cols, *[F.col(v).alias(f"__cold_{v}") for v in values], zero.alias("__cold_salt")
    )
    joined = salted.join(
        cold, _matching(pairs, null_safe) & (F.col("__salt") == F.col("__cold_salt")), "left"
    )
    return joined.select(
        *fact.columns,
        *[
            F.when(F.col("__hot").isNotNull(), F.col(f"__hot.{v}"))
            .otherwise(F.col(f"__cold_{v}"))
            .alias(v)
            for v in values
        ],
    )


def calendar_join(
    df: DataFrame, date_col: str, calendar: DataFrame, suffix: str, attributes: Sequence[str]
) -> DataFrame:
    """Attach calendar attributes of a date under role names such as ``anio_creacion``.

    The calendar has one row per day (11 years are 4,018 rows). It carries no hint: the
    optimizer sees its size and broadcasts it.
    """
    role = calendar.select(
        F.col("fecha").alias("__day"),
        *[F.col(source).alias(f"{name}_{suffix}") for source, name in attributes],
    )
    return df.join(role, F.to_date(df[date_col]) == role["__day"], "left").drop("__day")


def missing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (JON-5, DQ-19).

    The right side is reduced to distinct keys before it is shuffled, so repeated keys
    there cost nothing.
    """
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")
