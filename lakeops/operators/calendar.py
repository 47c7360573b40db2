"""Generated date range and its attributes (SRC-4, GLD-1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_range(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("fecha")
    )


def calendar_span(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and the last date of a column."""
    ends = df.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("fecha"))


def with_calendar(df: DataFrame) -> DataFrame:
    """Add the attributes of the calendar dimension to a column ``fecha``."""
    d = F.col("fecha")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    half = F.when(month <= 6, 1).otherwise(2)
    return df.select(
        "fecha",
        year.alias("y"),
        month.alias("m"),
        F.dayofmonth(d).alias("d"),
        quarter.alias("trimestre"),
        half.alias("semestre"),
        F.date_format(d, "EEEE").alias("nombre_dia"),
        F.date_format(d, "MMMM").alias("nombre_mes"),
        F.format_string("%d-%02d", year, month).alias("anio_mes"),
        F.concat(year, F.lit("-T"), quarter).alias("anio_trimestre"),
        F.concat(year, F.lit("-S"), half).alias("anio_semestre"),
        F.weekofyear(d).alias("semana_iso"),
        F.dayofweek(d).isin(1, 7).alias("es_fin_de_semana"),
    )
