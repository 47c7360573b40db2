"""Text cleaning and mapping of free text onto categories (CLN-1..8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(col: Column) -> Column:
    return F.lower(F.trim(col))


def upper_trim(col: Column) -> Column:
    return F.upper(F.trim(col))


def or_default(col: Column, value) -> Column:
    """Replace NULL by a constant."""
    return F.coalesce(col, F.lit(value))


def is_blank(col: Column) -> Column:
    """TRUE for NULL, empty and all-space text."""
    return col.isNull() | (F.trim(col) == "")


def title_or_default(col: Column, value: str) -> Column:
    """Blank becomes the default, the rest is trimmed and title-cased."""
    return F.when(is_blank(col), F.lit(value)).otherwise(F.initcap(F.trim(col)))


def pattern_category(
    col: Column,
    rules: Sequence[tuple[str, str]],
    when_null: str | None = None,
    otherwise: Column | str | None = None,
) -> Column:
    """First matching LIKE pattern wins, compared against lower-cased trimmed text.

    ``when_null`` is the label of a NULL input. Without ``otherwise`` the cleaned text
    itself is the result.
    """
    text = lower_trim(col)
    expr = F
    if when_null is not None:
        expr = expr.when(col.isNull(), F.lit(when_null))
    for pattern, label in rules:
        expr = expr.when(text.like(pattern), F.lit(label))
    if otherwise is None:
        return expr.otherwise(text)
    return expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def word_category(
    col: Column, words: Mapping[str, Sequence[str]], otherwise: str, when_null: str
) -> Column:
    """Map a word onto the label whose list contains it; NULL has a label of its own."""
    text = lower_trim(col)
    expr = F.when(col.isNull(), F.lit(when_null))
    for label, members in words.items():
        expr = expr.when(text.isin(list(members)), F.lit(label))
    return expr.otherwise(F.lit(otherwise))
