"""Curated tables kept up by change: what a run has to make again, and from what (PIP-1, SNK-3).

A refresh compares two states of its inputs by their manifests. Months whose files differ are read and made
again; other months keep their files. Values that a row takes from its whole entity (latest donation, totals)
come from the entity's months, small mergeable rows kept as tables of their own; a month elsewhere is
made again only if it holds a row of an entity whose values did change.

Where facts did not change and only values of their entities did, the stored rows are taken as they lie, month
by month, and get the new values of those entities from a broadcast: no row is shuffled (``_carried``).

Each function takes a ``Change`` and returns the rows, the partitions they replace, or None for all, and whether
the rows lie by month already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import days_since, two_digits
from ..operators.aggregates import merged_stats
from ..operators.dedup import row_hash
from ..session import stored as _stored
from ..sinks.versioned import NO_VALUE, of_keys, without_keys
from ..sinks.writers import gathered
from . import gold as G

Refreshed = tuple[DataFrame, "set[str] | None", bool]

_ALL_STATS = ("total", "count", "mean", "first", "last", "max", "min")


@dataclass(frozen=True)
class Change:
    """Old and new states of the tables below a run's root. ``new(name, months)`` and ``old(...)`` read
    some months or all; ``months(name)`` are those whose files differ."""

    spark: SparkSession
    settings: object
    new: Callable[..., DataFrame]
    old: Callable[..., DataFrame]
    months: Callable[[str], set[str]]


def by_months(rows: DataFrame) -> DataFrame:
    """Rows of a month brought together for the write."""
    return gathered(rows, ("y", "m"))


def _months(rows: DataFrame) -> set[str]:
    """Partition paths of the distinct months of rows with y and m."""
    path = lambda v: NO_VALUE if v is None else v
    return {f"y={path(r['y'])}/m={path(r['m'])}" for r in rows.select("y", "m").distinct().collect()}


def _odd(states: Iterable[DataFrame], key: str) -> DataFrame:
    """Keys whose rows are not the same in both states."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").select(key).distinct()


def _altered_rows(c: Change, table: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Keys of rows that came, went or changed in ``columns`` (all by default)."""
    states = [s if columns is None else s.select(key, *columns) for s in (c.old(table), c.new(table))]
    return _odd([s.select(key, row_hash(s).alias("h")) for s in states], key)


def _altered_entities(c: Change, table: str, key: str, stats: Sequence[str] = _ALL_STATS) -> DataFrame:
    """Entities whose statistics changed; only those with a row in a changed month can have."""
    months = c.months(table)
    names = {s: s for s in stats}
    seen = [state(table, months).select(key) for state in (c.old, c.new)]
    near = _stored(reduce(DataFrame.unionByName, seen).distinct(), "near")
    return _odd([merged_stats(of_keys(s(table), near, [key]), [key], names, c.settings.scale) for s in (c.old, c.new)], key)


def _having(c: Change, table: str, keys: DataFrame, key: str) -> set[str]:
    """Months that hold a row of these entities."""
    return _months(of_keys(c.new(table), keys, [key]))


def by_month(
    source: str, build: Callable[[Change, DataFrame], DataFrame], row_wise: bool = False
) -> Callable[[Change], Refreshed]:
    """For tables whose rows come from one row, or one month, of their source each. ``row_wise``: ``build`` leaves
    rows in the tasks that hold their months, or brings them there."""

    def refresh(c: Change) -> Refreshed:
        months = c.months(source)
        return build(c, c.new(source, months)), months, row_wise

    return refresh


def _carried(stored: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Stored rows with other ``values``, columns of theirs, for the entities that have a row there."""
    names = [n for n in values.columns if n != key]
    side = values.select(F.col(key).alias("__key"), F.struct(F.lit(1).alias("__found"), *names).alias("__values"))
    rows = stored.join(F.broadcast(side), F.col(key).eqNullSafe(F.col("__key")), "left")
    found = F.col("__values").isNotNull()
    return rows.select(*[F.when(found, F.col(f"__values.{n}")).otherwise(F.col(n)).alias(n) if n in names else n for n in stored.columns])


def fact_donations(c: Change) -> Refreshed:
    state, key, s = "parts.donante_mes", "id_donante", c.settings
    later = _stored(_altered_entities(c, state, key, ["last"]), "later")
    anew, months = c.months("silver.donaciones"), _having(c, state, later, key)
    last = G.donor_last(c.new(state))
    if later.count() > G.FEW_ENTITIES:
        anew |= months
    rows = by_months(G.fact_donations(c.new("silver.donaciones", anew), s.as_of, s.critical, last))
    if months - anew:
        days = of_keys(last[0], later, [key]).select(key, days_since(F.col("__last"), s.as_of).alias("recencia_donaciones_dias"))
        rows = rows.unionByName(_carried(c.old("gold.fact_donaciones", months - anew), key, _stored(days, "days")))
    return rows, anew | months, True


def features(
    table: str, dim: str, state: str, key: str, build: Callable[[Change, DataFrame, DataFrame], DataFrame]
) -> Callable[[Change], Refreshed]:
    """One row per entity: those whose attributes or statistics changed are made again."""

    def refresh(c: Change) -> Refreshed:
        near = _altered_rows(c, dim, key).unionByName(_altered_entities(c, state, key)).distinct()
        near = _stored(near, "altered")
        again = build(c, of_keys(c.new(dim), near, [key]), of_keys(c.new(state), near, [key]))
        return without_keys(c.old(table), near, [key]).unionByName(again), None, False

    return refresh


def dash_donations(c: Change) -> Refreshed:
    state, key, s = "parts.donante_mes", "id_donante", c.settings
    dim, fact, table = "gold.dim_donantes", "gold.fact_donaciones", "gold.dashboard_donaciones"
    near = _altered_entities(c, state, key).unionByName(_altered_rows(c, dim, key, G.DONOR_ATTRIBUTES)).distinct()
    near = _stored(near, "altered")
    # Other months of the fact differ at most in the days since their donors' last donation.
    anew, months = c.months("silver.donaciones"), _having(c, state, near, key)
    if near.count() > G.FEW_ENTITIES:
        anew |= c.months(fact) | months
    metrics = G.donor_metrics(c.new(state), s.scale)
    rows = G.dash_donations(c.new(fact, anew), c.new(dim), s.as_of, s.scale, s.size, metrics, by_months)
    if months - anew:
        of_donor = of_keys(metrics[0], near, [key]).join(c.new(dim).select(key, *G.DONOR_ATTRIBUTES), key, "left")
        values = of_donor.withColumns(G.donor_values(s.as_of))
        values = _stored(values.withColumn("recencia_donaciones_dias", F.col("recencia_dias")).drop("__last"), "donors")
        rows = rows.unionByName(_carried(c.old(table, months - anew), key, values))
    return rows, anew | months, True


def dash_expenses(c: Change) -> Refreshed:
    s, suppliers, cases, key = c.settings, "parts.proveedor_mes", "parts.caso_mes", "id_proveedor"
    dim, fact, table = "gold.dim_proveedores", "gold.fact_gastos", "gold.dashboard_gastos"
    near = _altered_entities(c, suppliers, key).unionByName(_altered_rows(c, dim, key)).distinct()
    near = _stored(near, "altered")
    anew, months = c.months(fact), _having(c, suppliers, near, key)
    anew |= _having(c, cases, _stored(_altered_rows(c, "silver.casos", "id_caso"), "altered"), "id_caso")
    if near.count() > G.FEW_ENTITIES:
        anew |= months
    metrics = G.supplier_metrics(c.new(suppliers), s.scale)
    rows = G.dash_expenses(
        c.new(fact, anew), c.new(dim), c.new("silver.casos"), s.as_of, s.scale, s.expense_amount, metrics, by_months
    )
    if months - anew:
        values = of_keys(metrics[0], near, [key]).join(G.supplier_attributes(c.new(dim)), key, "left")
        rows = rows.unionByName(_carried(c.old(table, months - anew), key, _stored(values, "suppliers")))
    return rows, anew | months, True


def dash_finance(c: Change) -> Refreshed:
    """The sums of other months are taken from the stored table; the balances run over all months again."""
    budgets = _stored(_altered_rows(c, "silver.casos", "id_caso", ["presupuesto_estimado"]), "altered")
    months = c.months("silver.donaciones") | c.months("silver.gastos") | _having(c, "parts.caso_mes", budgets, "id_caso")
    sides = G.finance_rows(c.new("silver.donaciones", months), c.new("silver.gastos", months), c.new("silver.casos"))
    day, none = F.col("anio_mes"), F.lit(NO_VALUE)
    year, month = F.coalesce(F.year(day).cast("string"), none), F.coalesce(two_digits(F.month(day)), none)
    path = F.concat(F.lit("y="), year, F.lit("/m="), month)
    kept = c.old("gold.dashboard_financiero").select(*G.SIDE_TOTALS).filter(~path.isin(sorted(months)))
    return G.balanced(kept.unionByName(G.side_totals(*sides, c.settings.scale)), c.settings.scale), None, False
