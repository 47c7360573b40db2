"""Row rules with quarantine, and table-level checks (DQ-1..16, DQ-24..26)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import AsOf, as_of_instant

ERRORS = "dq_errors"


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when ``broken`` is TRUE; an unknown outcome passes."""

    code: str
    broken: Column


class QualityError(ValueError):
    """A table-level check failed."""


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``dq_errors``: the codes of all broken rules, in rule order, in one projection."""
    codes = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.code)) for r in rules]))
    if len({r.code for r in rules}) < len(rules):
        codes = F.array_distinct(codes)
    return df.withColumn(ERRORS, codes)


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(ERRORS) == 0).drop(ERRORS)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(ERRORS) > 0)


# Rule builders -------------------------------------------------------------------------


def negative(code: str, column: str) -> Rule:
    return Rule(code, F.col(column) < 0)


def in_future(code: str, column: str, as_of: AsOf) -> Rule:
    return Rule(code, F.col(column) > as_of_instant(as_of))


def before(code: str, column: str, day: dt.date) -> Rule:
    return Rule(code, F.col(column) < F.lit(day))


def outside(code: str, column: str, day: dt.date, as_of: AsOf) -> Rule:
    """Before the first allowed day or after the reference instant."""
    c = F.col(column)
    return Rule(code, (c < F.lit(day)) | (c > as_of_instant(as_of)))


def missing(code: str, column: str) -> Rule:
    return Rule(code, F.col(column).isNull())


def still_default(code: str, column: str, default: str) -> Rule:
    return Rule(code, F.col(column) == default)


def bad_email(code: str, column: str, default: str) -> Rule:
    """Not the placeholder and without an ``@``."""
    c = F.col(column)
    return Rule(code, (c != default) & ~c.contains("@"))


def amount_bounds(code: str, column: str, low: float, high: float) -> Rule:
    return Rule(code, ~F.col(column).between(low, high))


def recent_years(code: str, column: str, years: int, as_of: AsOf) -> Rule:
    """Older than ``years`` years or later than the reference instant."""
    now = as_of_instant(as_of)
    c = F.col(column)
    return Rule(code, (c < F.add_months(now, -12 * years)) | (c > now))


# Table-level checks --------------------------------------------------------------------


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def check_columns(df: DataFrame, required: Sequence[str], table: str) -> DataFrame:
    gone = missing_columns(df, required)
    if gone:
        raise QualityError(f"table {table!r} lacks required columns: {', '.join(gone)}")
    return df


def null_like(df: DataFrame, column: str) -> Column:
    """NULL, or NaN where the type knows NaN."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for the columns the frame has; one pass over the data."""
    wanted = [c for c in (columns or df.columns) if c in df.columns]
    counts = df.agg(*[F.count_if(null_like(df, c)).alias(c) for c in wanted])
    return counts.unpivot([], wanted, "column_name", "null_count")


def null_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """The profile as a dict; its size is the number of columns."""
    return {r["column_name"]: r["null_count"] for r in null_profile(df, columns).collect()}


def year_outside(column: str, min_year: int, max_year: int) -> Column:
    year = F.year(column)
    return (year < min_year) | (year > max_year)


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: for every named condition, the number of rows where it is TRUE."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])


def assert_clean(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Raise when any condition holds for any row. All conditions share one pass."""
    counts = violations(df, checks).first().asDict()
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise QualityError("; ".join(f"{name}: {n} rows" for name, n in broken.items()))
    return df


def check_years(df: DataFrame, column: str, min_year: int = 2020, max_year: int = 2030) -> DataFrame:
    return assert_clean(df, {f"{column} outside {min_year}..{max_year}": year_outside(column, min_year, max_year)})


def check_positive(df: DataFrame, column: str) -> DataFrame:
    return assert_clean(df, {f"{column} not positive": F.col(column) <= 0})


def summary(df: DataFrame, sample: int = 5) -> dict:
    """Row count, columns and a few rows, for logs."""
    return {
        "rows": df.count(),
        "columns": len(df.columns),
        "names": list(df.columns),
        "sample": [r.asDict() for r in df.limit(sample).collect()],
    }


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows on the way through: the numbers arrive with the action that writes the
    frame and cost no job of their own."""
    seen = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [m.alias(k) for k, m in metrics.items()]
    return df.observe(seen, *exprs), seen
