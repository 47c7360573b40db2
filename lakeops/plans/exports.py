"""Export of curated tables as y/m/d folders with external tables on top (MRT-1)."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..sinks import writers as W

# Column that holds the month of a row. Tables without one are exported unpartitioned.
MONTH_COLUMNS = {
    "dim_calendario": "anio_mes",
    "dim_donantes": "anio_mes_creacion",
    "dim_casos": "fecha_ingreso",
    "fact_donaciones": "anio_mes_donacion",
    "fact_gastos": "fecha_pago",
    "feat_donantes": "anio_mes_creacion",
    "feat_casos": "fecha_ingreso",
    "dashboard_donaciones": "anio_mes",
    "dashboard_gastos": "anio_mes",
    "dashboard_financiero": "anio_mes",
}

# Tables stored by the month they are exported by: a scan of one holds few months a task.
BY_MONTH = ("dim_donantes", "dim_casos", "fact_donaciones", "fact_gastos", "dashboard_donaciones", "dashboard_gastos")


def export_gold(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, database: str, stored: bool = False
) -> list[str]:
    """Write every table below ``root`` and register it as ``database.table``. ``stored`` tables are read from
    a run's own (``registry.read``); those of ``BY_MONTH`` then need no shuffle."""

    def export(item: tuple[str, DataFrame]) -> None:
        name, df = item
        path = f"{root}/{name}"
        month = MONTH_COLUMNS.get(name)
        if month:
            W.write_export(df, path, month, laid_out=stored and name in BY_MONTH)
        else:
            W.write_snapshot(df, path)

    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(export, tables.items()))
    for name in tables:
        W.register_external(spark, f"{database}.{name}", f"{root}/{name}", partitioned=name in MONTH_COLUMNS)
    return [f"{database}.{name}" for name in tables]
