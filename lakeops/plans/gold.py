"""Curated layer: dimensions, facts, features and dashboards (GLD-1..15).

Cleaned frames in, curated frames out. ``scale`` asks for exact money sums (see
``functions.numbers``); thresholds default to the business rules.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.buckets import bucket, exceeds, flag
from ..functions.casts import month_text_to_date
from ..functions.dates import AsOf, days_since, month_key, months_since, partition_columns
from ..functions.numbers import log_amount, mean, ratio, ratio_or_zero, total
from ..functions.text import lower_trim, pattern_category
from ..operators import quality as dq
from ..operators.aggregates import amount_partials, amount_stats, amount_where, merged_stats, monthly_rollup
from ..operators.calendar import date_range, with_calendar
from ..operators.filters import in_status, positive_and_dated
from ..operators.joins import calendar_join, lookup_join
from ..operators.reconcile import stack
from ..operators.windows import per_entity, running_total, trailing_total, with_hot
from ..session import stored
from . import rules as R

CALENDAR_SPAN = (dt.date(2020, 1, 1), dt.date(2030, 12, 31))

# Calendar attribute -> its name inside a role ("anio" + "_creacion").
CALENDAR_ROLE = [
    ("y", "anio"),
    ("m", "mes"),
    ("anio_mes", "anio_mes"),
    ("trimestre", "trimestre"),
    ("anio_trimestre", "anio_trimestre"),
    ("semestre", "semestre"),
    ("anio_semestre", "anio_semestre"),
    ("semana_iso", "semana"),
]


def _months(date: str) -> dict:
    return partition_columns(F.col(date), day=None)


# Dimensions ------------------------------------------------------------------------------


def dim_calendar(spark: SparkSession, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return with_calendar(date_range(spark, first or CALENDAR_SPAN[0], last or CALENDAR_SPAN[1]))


def dim_donors(donors: DataFrame, calendar: DataFrame, as_of: AsOf = None) -> DataFrame:
    country = F.lower("pais")
    home = R.COUNTRY.lower()
    enriched = donors.withColumns(
        {
            "es_donante_internacional": flag(country != home),
            "es_donante_local": flag(country == home),
            "antiguedad_donante_meses": months_since(F.col("created_at"), as_of),
            "contacto_valido": flag(F.col("correo").contains("@")),
        }
    )
    out = calendar_join(enriched, "created_at", calendar, "creacion", CALENDAR_ROLE)
    return out.withColumns(_months("created_at"))


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    patterns, otherwise = R.SUPPLIER_CATEGORY
    return suppliers.withColumns(
        {
            "ciudad_normalizada": lower_trim(F.col("ciudad")),
            "tiene_id_valido": flag(F.col("nit") != ""),
            "categoria_proveedor": pattern_category(
                F.col("tipo_proveedor"), patterns, otherwise=otherwise
            ),
        }
    )


def dim_cases(cases: DataFrame, as_of: AsOf = None) -> DataFrame:
    return cases.withColumns(
        {
            "es_caso_urgente": flag(F.col("estado") == R.CASE_URGENT),
            "dias_en_sistema": days_since(F.col("fecha_ingreso"), as_of),
        }
        | _months("fecha_ingreso")
    )


def dim_homes(homes: DataFrame, cases: DataFrame) -> DataFrame:
    """Homes with case counts, occupancy and turnover."""
    counts = ["numero_casos_total", "numero_casos_activos", "numero_casos_finalizado"]
    open_case = F.col("fecha_salida").isNull()
    per_home = cases.groupBy("id_hogar_de_paso").agg(
        F.count("id_caso").alias(counts[0]),
        F.count_if(open_case).alias(counts[1]),
        F.count_if(~open_case).alias(counts[2]),
    )
    every = F.col(counts[0])
    out = (
        homes.join(per_home, "id_hogar_de_paso", "left")
        .fillna(0, subset=counts)
        .withColumns(
            {
                "tasa_ocupacion": ratio_or_zero(F.col(counts[1]), F.col("cupo_maximo")),
                "rotacion_casos": ratio_or_zero(F.col(counts[2]), every),
            }
        )
    )
    return out.withColumns(
        {
            "clasificacion_ocupacion": bucket(F.col("tasa_ocupacion"), *R.OCCUPANCY),
            "clasificacion_rotacion": bucket(F.col("rotacion_casos"), *R.TURNOVER),
        }
    )


# Facts -----------------------------------------------------------------------------------


Metrics = tuple[DataFrame, DataFrame]  # a row per entity, and those of the most frequent ones
Layout = Callable[[DataFrame], DataFrame]  # brings the rows of a month together, or leaves them where they are


def as_is(rows: DataFrame) -> DataFrame:
    return rows


# Entities whose attributes and metrics, one row each, are ever broadcast as a whole.
FEW_ENTITIES = 500_000


def completed(donations: DataFrame) -> DataFrame:
    return donations.filter(in_status("estado", R.DONATION_DONE))


def paid_expenses(expenses: DataFrame) -> DataFrame:
    return expenses.filter(in_status("estado", R.EXPENSE_DONE))


def donor_months(donations: DataFrame, scale: int | None = None) -> DataFrame:
    """Mergeable statistics of completed donations by donor and month, the rows of a month in few tasks."""
    return _by_month(completed(donations), "id_donante", "id_donacion", "fecha_donacion", scale, dealt=True)


def supplier_months(expenses: DataFrame, scale: int | None = None) -> DataFrame:
    return _by_month(paid_expenses(expenses), "id_proveedor", "id_gasto", "fecha_pago", scale)


def case_months(expenses: DataFrame, scale: int | None = None) -> DataFrame:
    """As ``donor_months``."""
    return _by_month(paid_expenses(expenses), "id_caso", "id_gasto", "fecha_pago", scale, dealt=True)


MONTH_SLICES = 8  # tasks at most that share a month of ``_by_month``


def _by_month(rows: DataFrame, key: str, row_id: str, date: str, scale: int | None, dealt: bool = False) -> DataFrame:
    """``dealt``: rows are brought together by month and a slice of the keys, which serves the aggregation and a
    write by month in one shuffle. For entities with few rows a month, which combining in front of the shuffle
    would hardly reduce."""
    months = rows.drop("y", "m").withColumns(_months(date))
    if not dealt:
        return amount_partials(months, [key, "y", "m"], "monto", row_id, date, scale)
    narrow = months.select(key, row_id, "monto", date, "y", "m", F.pmod(F.xxhash64(key), F.lit(MONTH_SLICES)).alias("__slice"))
    grouped = amount_partials(narrow.repartition("y", "m", "__slice"), [key, "y", "m", "__slice"], "monto", row_id, date, scale)
    return grouped.drop("__slice")


def donor_last(months: DataFrame) -> Metrics:
    """Latest completed donation of each donor, from its months."""
    return with_hot(merged_stats(months, ["id_donante"], {"last": "__last", "rows": "__rows"}), ["id_donante"], "__rows")


def fact_donations(
    donations: DataFrame,
    as_of: AsOf = None,
    critical: float = R.DONATION_CRITICAL,
    last: Metrics | None = None,
) -> DataFrame:
    """Completed donations with per-row and per-donor recency. ``last`` gives the donors' latest dates
    where ``donations`` are not all of them."""
    date, amount = F.col("fecha_donacion"), F.col("monto")
    done = completed(donations)
    last, hot = last or per_entity(done, ["id_donante"], {"__last": F.max("fecha_donacion")})
    out = lookup_join(done, last, ["id_donante"], hot=hot, null_safe=True, salt=["id_donacion"])
    return out.select(
        "id_donacion",
        "id_donante",
        "monto",
        "fecha_donacion",
        "medio_pago",
        "estado",
        flag(amount > critical).alias("es_donacion_critica"),
        log_amount(amount).alias("monto_log"),
        days_since(date, as_of).alias("recencia_donacion_dias"),
        days_since(F.col("__last"), as_of).alias("recencia_donaciones_dias"),
        month_key(date).alias("anio_mes_donacion"),
        bucket(amount, *R.DONATION_AMOUNT).alias("categoria_monto"),
        *[c.alias(n) for n, c in _months("fecha_donacion").items()],
    )


def fact_expenses(expenses: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Paid expenses."""
    return paid_expenses(expenses).select(
        "id_gasto",
        "id_caso",
        "id_proveedor",
        "monto",
        "fecha_pago",
        "medio_pago",
        "estado",
        F.col("nombre_gasto").alias("descripcion"),
        "created_at",
        log_amount(F.col("monto")).alias("monto_log"),
        days_since(F.col("fecha_pago"), as_of).alias("recencia_dias"),
        *[c.alias(n) for n, c in _months("fecha_pago").items()],
    )


# Features --------------------------------------------------------------------------------


_DONOR_STATS = {
    "total": "total_donado",
    "count": "num_donaciones",
    "mean": "promedio_donacion",
    "first": "primera_donacion",
    "last": "ultima_donacion",
    "max": "monto_maximo",
    "min": "monto_minimo",
}
_CASE_STATS = {
    "total": "costo_total_caso",
    "count": "num_gastos_caso",
    "mean": "promedio_gasto_caso",
    "max": "gasto_maximo_caso",
}
_SUPPLIER_STATS = {
    "total": "total_gastado_proveedor",
    "count": "num_transacciones",
    "mean": "promedio_transaccion",
    "last": "ultimo_pago_proveedor",
}


def _stats(rows: DataFrame, key: str, row_id: str, names: dict, date: str, scale: int | None) -> DataFrame:
    """Statistics per entity, of fact rows or of their months."""
    if row_id in rows.columns:
        return amount_stats(rows, [key], "monto", row_id, names, date=date, scale=scale)
    return merged_stats(rows, [key], names, scale)


def feat_donors(
    dim: DataFrame, fact: DataFrame, as_of: AsOf = None, scale: int | None = None
) -> DataFrame:
    """``fact`` may also be the donors' months."""
    stats = _stats(fact, "id_donante", "id_donacion", _DONOR_STATS, "fecha_donacion", scale)
    given = F.col("total_donado")
    return dim.join(stats, "id_donante", "left").withColumns(
        {
            "recencia_dias": days_since(F.col("ultima_donacion"), as_of),
            "categoria_financiera": bucket(given, *R.DONOR_TIER),
            "donante_recurrente_ml": flag(F.col("num_donaciones") >= R.DONOR_RECURRENT),
            "ltv": given,
            "velocidad_crecimiento": ratio(given, F.col("antiguedad_donante_meses")),
        }
    )


def feat_cases(dim: DataFrame, fact: DataFrame, scale: int | None = None) -> DataFrame:
    """``fact`` may also be the cases' months."""
    stats = _stats(fact, "id_caso", "id_gasto", _CASE_STATS, "fecha_pago", scale)
    cost = F.col("costo_total_caso")
    return dim.join(stats, "id_caso", "left").withColumns(
        {
            "tiempo_resolucion_dias": F.datediff("fecha_salida", "fecha_ingreso"),
            "es_caso_alto_costo": flag(cost > R.CASE_HIGH_COST),
            "categoria_costo": bucket(cost, *R.CASE_COST),
        }
    )


def feat_suppliers(
    suppliers: DataFrame, fact: DataFrame, scale: int | None = None, importance=R.SUPPLIER_IMPORTANCE
) -> DataFrame:
    """``fact`` may also be the suppliers' months."""
    stats = _stats(fact, "id_proveedor", "id_gasto", _SUPPLIER_STATS, "fecha_pago", scale)
    return suppliers.join(stats, "id_proveedor", "left").withColumn(
        "importancia_proveedor", bucket(F.col("total_gastado_proveedor"), *importance)
    )


# Dashboards ------------------------------------------------------------------------------


def _with_attributes(metrics: tuple[DataFrame, DataFrame], lookup: DataFrame, key: str):
    """Extend per-entity metrics, and their hot rows, by attributes of the entity.

    Metrics and lookup both have one row per entity, so the wide fact is joined once
    instead of once for the lookup and once for the metrics.
    """
    every, hot = metrics
    return every.join(lookup, key, "left"), hot.join(lookup, key, "left")


DONOR_ATTRIBUTES = ["donante", "correo", "ciudad", "pais", "canal_origen"]


def donor_metrics(months: DataFrame, scale: int | None = None) -> Metrics:
    names = {
        "count": "frecuencia_donaciones",
        "total": "monto_total_donado",
        "mean": "promedio_donacion_donante",
        "max": "monto_maximo_donante",
        "min": "monto_minimo_donante",
        "last": "__last",
        "rows": "__rows",
    }
    return with_hot(merged_stats(months, ["id_donante"], names, scale), ["id_donante"], "__rows")


def supplier_metrics(months: DataFrame, scale: int | None = None) -> Metrics:
    names = {
        "count": "frecuencia_gastos",
        "total": "monto_total_gastado",
        "max": "monto_maximo_gasto",
        "min": "monto_minimo_gasto",
        "rows": "__rows",
    }
    return with_hot(merged_stats(months, ["id_proveedor"], names, scale), ["id_proveedor"], "__rows")


def dash_donations(
    fact: DataFrame,
    dim: DataFrame,
    as_of: AsOf = None,
    scale: int | None = None,
    size=R.DONATION_SIZE,
    metrics: Metrics | None = None,
    layout: Layout = as_is,
) -> DataFrame:
    """Donations with donor attributes and the donor's recency, frequency and value. ``metrics``
    (``donor_metrics``) stand in where ``fact`` does not hold all rows. ``layout`` is applied to the joined
    rows; what follows from one row alone is added after it and travels through no shuffle."""
    amount, date = F.col("monto"), F.col("fecha_donacion")
    attributes = DONOR_ATTRIBUTES
    metrics = metrics or per_entity(
        fact,
        ["id_donante"],
        {
            "frecuencia_donaciones": F.count("id_donacion"),
            "monto_total_donado": total(amount, scale),
            "promedio_donacion_donante": mean(amount, scale),
            "monto_maximo_donante": F.max(amount),
            "monto_minimo_donante": F.min(amount),
            "__last": F.max(date),
        },
    )
    lookup, hot = _with_attributes(metrics, dim.select("id_donante", *attributes), "id_donante")
    again = {
        "monto_log": log_amount(amount),
        "recencia_donacion_dias": days_since(date, as_of),
        "anio_mes_donacion": month_key(date),
        "categoria_monto": bucket(amount, *R.DONATION_AMOUNT),
    }
    narrow = fact.drop(*again)
    out = layout(lookup_join(narrow, lookup, ["id_donante"], hot=hot, null_safe=True, salt=["id_donacion"]))
    return out.select(
        *[again[c].alias(c) if c in again else c for c in fact.columns],
        *attributes,
        F.year(date).alias("anio"),
        F.month(date).alias("mes"),
        month_key(date).alias("anio_mes"),
        "frecuencia_donaciones",
        "monto_total_donado",
        "promedio_donacion_donante",
        "monto_maximo_donante",
        "monto_minimo_donante",
        *[c.alias(n) for n, c in donor_values(as_of).items()],
        bucket(amount, *size).alias("tamano_donacion"),
    )


def donor_values(as_of: AsOf = None) -> dict:
    """What a donation's row says of its donor besides attributes and metrics."""
    return {
        "recencia_dias": days_since(F.col("__last"), as_of),
        "segmento_rfm": bucket(F.col("monto_total_donado"), *R.DONOR_TIER),
    }


def supplier_attributes(dim: DataFrame) -> DataFrame:
    return dim.select(
        "id_proveedor",
        "nombre_proveedor",
        "categoria_proveedor",
        F.col("ciudad_normalizada").alias("proveedor_ciudad"),
        "tiene_id_valido",
    )


def dash_expenses(
    fact: DataFrame,
    dim_suppliers: DataFrame,
    cases: DataFrame,
    as_of: AsOf = None,
    scale: int | None = None,
    amounts=R.EXPENSE_AMOUNT,
    metrics: Metrics | None = None,
    layout: Layout = as_is,
) -> DataFrame:
    """Expenses with supplier and case attributes, supplier metrics and budget status. ``metrics``
    (``supplier_metrics``) stand in where ``fact`` does not hold all rows. ``layout`` as in ``dash_donations``;
    values of suppliers are broadcast after it if there are no more than ``FEW_ENTITIES``."""
    amount, date = F.col("monto"), F.col("fecha_pago")
    of_supplier = supplier_attributes(dim_suppliers)
    of_case = cases.select(
        "id_caso",
        "nombre_caso",
        F.col("estado").alias("estado_caso"),
        "presupuesto_estimado",
        "fecha_salida",
    )
    metrics = metrics or per_entity(
        fact,
        ["id_proveedor"],
        {
            "frecuencia_gastos": F.count("id_gasto"),
            "monto_total_gastado": total(amount, scale),
            "monto_maximo_gasto": F.max(amount),
            "monto_minimo_gasto": F.min(amount),
        },
    )
    again = {"monto_log": log_amount(amount), "recencia_dias": days_since(date, as_of)}
    out = fact.drop(*again)
    every = stored(metrics[0].join(of_supplier, "id_proveedor", "left"), "suppliers")
    few = every.count() <= FEW_ENTITIES
    if not few:
        hot = metrics[1].join(of_supplier, "id_proveedor", "left")
        out = lookup_join(out, every, ["id_proveedor"], hot=hot, null_safe=True, salt=["id_gasto"])
    out = layout(lookup_join(out, of_case, ["id_caso"], hot=[R.NO_CASE], salt=["id_gasto"]))
    if few:
        out = lookup_join(out, F.broadcast(every), ["id_proveedor"], null_safe=True)
    return out.select(
        *[again[c].alias(c) if c in again else c for c in fact.columns],
        "nombre_proveedor",
        "categoria_proveedor",
        "proveedor_ciudad",
        "tiene_id_valido",
        "nombre_caso",
        "estado_caso",
        "presupuesto_estimado",
        "fecha_salida",
        F.col("fecha_salida").isNull().alias("es_caso_activo"),
        F.year(date).alias("anio"),
        F.month(date).alias("mes"),
        month_key(date).alias("anio_mes"),
        "frecuencia_gastos",
        "monto_total_gastado",
        "monto_maximo_gasto",
        "monto_minimo_gasto",
        days_since(date, as_of).alias("recencia_gasto_dias"),
        bucket(amount, *amounts).alias("categoria_monto"),
        exceeds(amount, F.col("presupuesto_estimado")).alias("sobrepresupuesto"),
    )


def finance_rows(
    donations: DataFrame, expenses: DataFrame, cases: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The columns of the two dashboards that the finance tables read, from cleaned tables.

    A finance month needs ids, amounts and the budget flag but none of the per-donor and
    per-supplier metrics, so it does not wait for the dashboards. The month is a date here,
    which spares formatting and parsing a text per row.
    """
    done = completed(donations).select(
        "id_donante",
        "monto",
        F.trunc("fecha_donacion", "month").alias("anio_mes"),
    )
    paid = paid_expenses(expenses).select(
        "id_proveedor",
        "id_caso",
        "monto",
        F.trunc("fecha_pago", "month").alias("anio_mes"),
    )
    budgets = cases.select("id_caso", "presupuesto_estimado")
    paid = lookup_join(paid, budgets, ["id_caso"], hot=[R.NO_CASE]).withColumn(
        "sobrepresupuesto", exceeds(F.col("monto"), F.col("presupuesto_estimado"))
    )
    return done, paid


def movements(donations: DataFrame, expenses: DataFrame) -> DataFrame:
    """Donations and expenses under one shape; one-sided columns are typed NULLs (SET-1)."""
    month = month_text_to_date(F.col("anio_mes")).alias("anio_mes")
    none = F.lit(None).cast("long")
    income = donations.select(
        month,
        "id_donante",
        none.alias("id_proveedor"),
        none.alias("id_caso"),
        "monto",
        F.lit(False).alias("es_gasto"),
        F.lit(False).alias("sobrepresupuesto"),
        "categoria_monto",
    )
    spend = expenses.select(
        month,
        none.alias("id_donante"),
        "id_proveedor",
        "id_caso",
        "monto",
        F.lit(True).alias("es_gasto"),
        "sobrepresupuesto",
        "categoria_monto",
    )
    return income.unionByName(spend)


def month_totals(moves: DataFrame, scale: int | None = None) -> DataFrame:
    """Money and distinct participants per month of the united movements."""
    amount = F.col("monto")
    return moves.groupBy("anio_mes").agg(
        amount_where(~F.col("es_gasto"), amount, scale).alias("total_donado"),
        amount_where(F.col("es_gasto"), amount, scale).alias("total_gastado"),
        amount_where(F.col("sobrepresupuesto"), amount, scale).alias("gastos_sobrepresupuesto"),
        F.countDistinct("id_caso").alias("casos_activos_mes"),
        F.countDistinct("id_donante").alias("donantes_activos_mes"),
        F.countDistinct("id_proveedor").alias("proveedores_activos_mes"),
    )


def side_totals(donations: DataFrame, expenses: DataFrame, scale: int | None = None) -> DataFrame:
    """Same result as ``month_totals(movements(...))``, with each side aggregated first.

    Several distinct counts in one group-by copy every row once per count. Donors occur only
    among donations, cases and suppliers only among expenses, so splitting the sides halves
    those copies, and the union is left with two rows per month.
    """
    amount = F.col("monto")
    income = donations.groupBy("anio_mes").agg(
        total(amount, scale).alias("total_donado"),
        F.countDistinct("id_donante").alias("donantes_activos_mes"),
    )
    spend = expenses.groupBy("anio_mes").agg(
        total(amount, scale).alias("total_gastado"),
        amount_where(F.col("sobrepresupuesto"), amount, scale).alias("gastos_sobrepresupuesto"),
        F.countDistinct("id_caso").alias("casos_activos_mes"),
        F.countDistinct("id_proveedor").alias("proveedores_activos_mes"),
    )
    money = ["total_donado", "total_gastado", "gastos_sobrepresupuesto"]
    people = ["casos_activos_mes", "donantes_activos_mes", "proveedores_activos_mes"]
    zero = {c: F.lit(0.0) for c in money} | {c: F.lit(0).cast("long") for c in people}
    padded = [
        side.withColumns({c: z for c, z in zero.items() if c not in side.columns})
        for side in (income, spend)
    ]
    months = stack(padded).groupBy("anio_mes").agg(*[F.sum(c).alias(c) for c in money + people])
    # Month text is parsed here, once per month, not once per row.
    if dict(months.dtypes)["anio_mes"] == "string":
        months = months.withColumn("anio_mes", month_text_to_date(F.col("anio_mes")))
    return months


def dash_finance(donations: DataFrame, expenses: DataFrame, scale: int | None = None) -> DataFrame:
    """Monthly balance, running balance, trailing quarters, budget share and runway.

    The windows run over one row per month; everything heavy happens before them.
    """
    return balanced(side_totals(donations, expenses, scale), scale)


SIDE_TOTALS = [
    "anio_mes", "total_donado", "total_gastado", "gastos_sobrepresupuesto",
    "casos_activos_mes", "donantes_activos_mes", "proveedores_activos_mes",
]


def balanced(months: DataFrame, scale: int | None = None) -> DataFrame:
    """The balances over one row of ``SIDE_TOTALS`` per month."""
    income, spend = F.col("total_donado"), F.col("total_gastado")
    out = months.withColumns(
        {
            "balance_neto": income - spend,
            "balance_acumulado": running_total(income - spend, "anio_mes", scale),
            "rolling_3m_ingresos": trailing_total(income, "anio_mes", scale=scale),
            "rolling_3m_gastos": trailing_total(spend, "anio_mes", scale=scale),
            "porcentaje_sobrepresupuesto": ratio(F.col("gastos_sobrepresupuesto"), spend),
        }
    )
    return out.withColumns(
        {
            "runway_financiero": ratio(F.col("balance_acumulado"), spend),
            "estado_financiero_mes": bucket(F.col("balance_neto"), *R.MONTH_STATE),
        }
    )


def balance_report(finance: DataFrame, months: int = 6) -> DataFrame:
    """The latest months for a reader: whole amounts and a rounded runway (GLD-15)."""
    whole = lambda c: F.col(c).cast("long").alias(c)
    return (
        finance.select(
            "anio_mes",
            whole("total_donado"),
            whole("total_gastado"),
            whole("balance_neto"),
            "estado_financiero_mes",
            F.round("runway_financiero", 2).alias("runway"),
        )
        .orderBy(F.desc("anio_mes"))
        .limit(months)
    )


def monthly_donations(
    raw: DataFrame,
    row_id: str = "id_donacion",
    min_year: int = 2020,
    max_year: int = 2030,
    scale: int | None = None,
) -> DataFrame:
    """Stand-alone monthly roll-up: required columns, cleaning, checks, totals (GLD-14).

    The two checks raise; they share one pass over two columns.
    """
    needed = [row_id, "fecha_donacion", "monto", "id_donante"]
    dq.check_columns(raw, needed, "donaciones")
    kind = dict(raw.dtypes)["fecha_donacion"]
    day = F.try_to_date("fecha_donacion") if kind == "string" else F.to_date("fecha_donacion")
    clean = positive_and_dated(
        raw.withColumns({"fecha_donacion": day, "monto": F.coalesce("monto", F.lit(0.0))}),
        "monto",
        "fecha_donacion",
    )
    dq.assert_clean(
        clean,
        {
            "fecha_donacion out of range": dq.year_outside("fecha_donacion", min_year, max_year),
            "monto not positive": F.col("monto") <= 0,
        },
    )
    return monthly_rollup(clean, "fecha_donacion", "monto", row_id, scale)
