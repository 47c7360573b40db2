"""Casts, text mapping, buckets and ratios on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import buckets as K
from lakeops.functions import casts as C
from lakeops.functions import dates as D
from lakeops.functions import numbers as N
from lakeops.functions import text as X
from lakeops.plans import rules as R


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_ids_survive_text_floats_and_junk(spark):
    values = ["12", "12.0", " 7 ", "abc", "", None, "9007199254740993"]
    assert column(spark, values, "string", C.to_long) == [12, 12, 7, None, None, None, 9007199254740993]
    assert column(spark, [3.0, float("nan"), None], "double", C.to_long) == [3, None, None]


def test_numbers_that_do_not_parse_are_null(spark):
    assert column(spark, ["1.5", "x", ""], "string", C.to_double) == [1.5, None, None]
    assert column(spark, ["4", "4.0", "x"], "string", C.to_int) == [4, 4, None]


def test_mixed_timestamps(spark):
    values = [
        "2024-01-15T10:00:00Z",
        "2024-01-15T10:00:00+02:00",
        "1705312800000000",
        "2024-13-01",
        "",
        None,
        "2024-01-15",
    ]
    got = column(spark, values, "string", lambda c: C.text_to_timestamp(c).cast("string"))
    assert got == [
        "2024-01-15 10:00:00",
        "2024-01-15 08:00:00",
        "2024-01-15 10:00:00",
        None,
        None,
        None,
        "2024-01-15 00:00:00",
    ]


def test_epoch_micros_as_number(spark):
    got = column(
        spark, [1705312800000000], "bigint", lambda c: C.to_timestamp(c, T.LongType()).cast("string")
    )
    assert got == ["2024-01-15 10:00:00"]


def test_conform_adds_casts_and_keeps(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    df = spark.createDataFrame([("1", "x")], "a string, extra string")
    assert C.conform(df, schema).first().asDict() == {"a": 1, "b": None, "extra": "x"}
    assert C.conform(df, schema, keep_extra=False).columns == ["a", "b"]


@pytest.mark.parametrize(
    "rules, expected",
    [
        (R.DONATION_PAYMENT, ["nequi", "transferencia", "transferencia", "tarjeta", "efectivo", ""]),
        (R.EXPENSE_PAYMENT, ["nequi", "transferencia", "transfer x", "tarjeta", "efectivo", ""]),
    ],
)
def test_payment_patterns(spark, rules, expected):
    values = [None, " Transferencia ", "TRANSFER x", "con Tarjeta", " Efectivo", " "]
    assert column(spark, values, "string", lambda c: X.pattern_category(c, rules, "nequi")) == expected


def test_status_words(spark):
    words = [w.upper() + " " for ws in R.DONATION_STATUS.values() for w in ws]
    got = column(
        spark,
        [None, "completado", "", *words],
        "string",
        lambda c: X.word_category(c, R.DONATION_STATUS, "pendiente", "completada"),
    )
    assert got == ["completada", "pendiente", "pendiente"] + ["completada"] * 6 + ["fallida"] * 4


def test_country_default_and_title(spark):
    values = [None, "", "  ", " costa RICA ", "peru"]
    got = column(spark, values, "string", lambda c: X.title_or_default(c, "Colombia"))
    assert got == ["Colombia", "Colombia", "Colombia", "Costa Rica", "Peru"]


@pytest.mark.parametrize(
    "rule, values, expected",
    [
        (R.DONATION_AMOUNT, [49999.0, 50000.0, 199999.0, 200000.0, None], ["Bajo", "Medio", "Medio", "Alto", "Alto"]),
        (R.DONATION_SIZE, [199999.0, 200000.0, 499999.0, 500000.0, None], ["pequena", "media", "media", "critica", "pequena"]),
        (R.DONOR_TIER, [200000.0, 200001.0, 700000.0, 700001.0, 2000000.0, 2000001.0, None], ["basico", "bronce", "bronce", "plata", "plata", "oro", "basico"]),
        (R.EXPENSE_AMOUNT, [199999.0, 200000.0, 400000.0, 400001.0, None], ["Pequeño", "Mediano", "Mediano", "Grande", "Grande"]),
        (R.CASE_COST, [100000.0, 100001.0, 500001.0, 1000000.0, 1000001.0, None], ["Bajo", "Medio", "Alto", "Alto", "Critico", "Bajo"]),
        (R.SUPPLIER_IMPORTANCE, [1000000.0, 1000001.0, 5000000.0, 5000001.0, None], ["Transaccional", "Proveedor Frecuente", "Proveedor Frecuente", "Socio Estratégico", "Transaccional"]),
        (R.OCCUPANCY, [0.39, 0.40, 0.85, 0.86, None], ["Baja", "Media", "Media", "Alta", "Baja"]),
        (R.TURNOVER, [0.29, 0.3, 0.7, 0.71, None], ["Baja rotación", "Media", "Media", "Alta rotación", "Baja rotación"]),
        (R.MONTH_STATE, [1.0, -1.0, 0.0, None], ["Superávit", "Déficit", "Equilibrado", "Equilibrado"]),
    ],
)
def test_buckets_on_their_bounds(spark, rule, values, expected):
    assert column(spark, values, "double", lambda c: K.bucket(c, *rule)) == expected


def test_flags(spark):
    assert column(spark, [500000.0, 500001.0, None], "double", lambda c: K.flag(c > 500000)) == [False, True, False]
    df = spark.createDataFrame([(5.0, 4.0), (4.0, 4.0), (5.0, None), (None, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(K.exceeds(F.col("a"), F.col("b"))).collect()] == [True, False, None, False]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (1, -1)], "a int, b int")
    assert [r[0] for r in df.select(N.ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, -1.0]
    assert [r[0] for r in df.select(N.ratio_or_zero(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0, 0.0]


def test_exact_totals_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double")
    row = df.agg(N.total(F.col("v"), 2), N.mean(F.col("v"), 2)).first()
    assert tuple(row) == (1.0, 0.1)
    nothing = df.filter("v IS NULL").agg(N.total(F.col("v"), 2), N.mean(F.col("v"), 2)).first()
    assert tuple(nothing) == (None, None)


def test_log_amount(spark):
    assert column(spark, [0.0, -1.0, -5.0, None], "double", N.log_amount) == [0.0, None, None, None]


def test_month_arithmetic(spark):
    day = dt.date(2024, 3, 31)
    values = [dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 3, 1)]
    got = column(spark, values, "date", lambda c: D.months_since(c, day))
    assert got[:2] == [1.0, 0.0] and abs(got[2] - 30 / 31) < 1e-8
    assert column(spark, values, "date", lambda c: D.days_since(c, day)) == [31, 0, 30]
    assert column(spark, values, "date", D.month_key) == ["2024-02", "2024-03", "2024-03"]
