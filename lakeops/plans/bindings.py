"""Raw entity tables drawn from the star-schema test tables.

Orders act as donations, line items as expenses, customers as donors, parts as cases,
suppliers as suppliers and nations as foster homes. Every entity is a projection over the
whole source table. Some values are made untidy on purpose (NULL keys, padded words,
negative amounts) so that each cleaning rule has work to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2002, 1, 1)
EVENTS_AS_OF = dt.date(2024, 2, 1)
FIRST_DAY = dt.date(1996, 1, 1)
CALENDAR = (dt.date(1994, 7, 1), dt.date(2002, 12, 31))
CENTS = 2

# Thresholds that fit the amounts of the test tables.
CRITICAL = 400_000
SIZE = ([(">=", 400_000, "critica"), (">=", 200_000, "media")], "pequena")
EXPENSE_AMOUNT = (
    [("<", 25_000, "Pequeño"), ("between", (25_000, 75_000), "Mediano")],
    "Grande",
)
SUPPLIER_IMPORTANCE = (
    [(">", 33_000_000, "Socio Estratégico"), (">", 31_000_000, "Proveedor Frecuente")],
    "Transaccional",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def donations(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    orders = orders if orders is not None else table(spark, sf_dir, "orders")
    return orders.selectExpr(
        "o_orderkey AS id_donacion",
        "CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS id_donante",
        "CASE WHEN o_orderkey % 15 <> 0 THEN o_orderkey % 2000 END AS id_caso",
        "o_orderdate AS fecha_donacion",
        "CASE WHEN o_orderkey % 101 = 0 THEN -o_totalprice ELSE o_totalprice END AS monto",
        """CASE o_orderpriority WHEN '1-URGENT' THEN ' Transferencia ' WHEN '2-HIGH' THEN
           'TRANSFER banco' WHEN '3-MEDIUM' THEN 'Tarjeta Visa' WHEN '5-LOW' THEN ' Efectivo'
           END AS medio_pago""",
        """CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN ' Aprobada '
           WHEN o_orderstatus = 'P' THEN 'Rechazada' ELSE 'en proceso' END AS estado""",
        "concat('c-', o_orderkey) AS comprobante",
        "CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS created_at",
        "CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS last_modified_at",
    )


def expenses(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Line items; the key (order, line) repeats, which gives the deduplication real work."""
    lines = lines if lines is not None else table(spark, sf_dir, "lineitem")
    return lines.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id_gasto",
        "concat('gasto ', l_returnflag) AS nombre_gasto",
        "l_shipdate AS fecha_pago",
        """CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 33 = 0 THEN
           l_partkey + 1000000000 ELSE l_partkey END AS id_caso""",
        """CASE l_returnflag WHEN 'A' THEN 'Transferencia Bancaria' WHEN 'N' THEN 'transfer'
           ELSE ' TARJETA ' END AS medio_pago""",
        "CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN NULL ELSE l_extendedprice END AS monto",
        "CASE l_linestatus WHEN 'F' THEN ' Pagado' ELSE 'en revision' END AS estado",
        "concat('g-', l_orderkey) AS comprobante",
        "CASE WHEN l_suppkey % 40 <> 0 THEN l_suppkey END AS id_proveedor",
        "l_shipdate AS created_at",
        "l_shipdate AS last_modified_at",
    )


def donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").selectExpr(
        "c_custkey AS id_donante",
        "CASE WHEN c_custkey % 40 <> 0 THEN concat(' ', c_name, ' ') END AS donante",
        """CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'sin correo' ELSE
           concat(' C', c_custkey, '@Mail.org ') END AS correo""",
        "CASE WHEN c_custkey % 3 <> 0 THEN concat(' 57-', c_custkey) END AS telefono",
        "c_mktsegment AS ciudad",
        """CASE WHEN c_nationkey = 3 THEN '  ' WHEN c_nationkey <> 4 THEN
           concat(' ', replace(n_name, '_', ' '), ' ') END AS pais""",
        "CASE WHEN c_acctbal > 0 THEN concat(c_mktsegment, ' ') END AS canal_origen",
        "date_add(DATE '1994-01-01', cast(c_custkey % 2000 AS int))::timestamp_ntz AS created_at",
        "date_add(DATE '1994-02-01', cast(c_custkey % 2000 AS int))::timestamp_ntz AS last_modified_at",
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id_caso",
        "CASE WHEN p_partkey % 70 <> 0 THEN concat(upper(p_name), ' ') END AS nombre_caso",
        "'activo' AS estado",
        "date_add(DATE '1995-06-01', cast(p_partkey * 7 % 1500 AS int))::timestamp_ntz AS fecha_ingreso",
        """CASE WHEN p_size <= 25 THEN date_add(DATE '1995-06-01',
           cast(p_partkey * 7 % 1500 AS int) + p_size)::timestamp_ntz END AS fecha_salida""",
        "CASE WHEN p_size % 3 = 0 THEN p_brand END AS veterinaria",
        "p_type AS diagnostico",
        "CASE WHEN p_size % 9 <> 0 THEN p_partkey % 25 END AS id_hogar_de_paso",
        "CASE WHEN p_size % 7 <> 0 THEN p_retailprice * 50 END AS presupuesto_estimado",
        "date_add(DATE '1995-06-01', cast(p_partkey * 7 % 1500 AS int))::timestamp_ntz AS last_modified_at",
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id_proveedor",
        "concat(' ', s_name) AS nombre_proveedor",
        """CASE s_suppkey % 5 WHEN 0 THEN 'Medico Veterinario' WHEN 1 THEN 'INSUMOS' WHEN 2 THEN
           'transporte urbano' WHEN 3 THEN 'otro' END AS tipo_proveedor""",
        """CASE s_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE
           concat('nit-', s_suppkey) END AS nit""",
        "concat('P', s_suppkey, '@Mail.org') AS correo",
        "' Bogota ' AS ciudad",
        "TIMESTAMP_NTZ '1995-01-01 00:00:00' AS last_modified_at",
    )


def homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey AS bigint) AS id_hogar_de_paso",
        "CASE WHEN n_nationkey <> 7 THEN concat(lower(n_name), ' ') END AS nombre_hogar",
        "CASE WHEN n_nationkey % 2 = 0 THEN ' fijo ' END AS tipo_hogar",
        """CASE WHEN n_nationkey = 0 THEN 0 WHEN n_nationkey = 24 THEN -1 WHEN n_nationkey <> 5
           THEN 30 + 2 * n_nationkey END AS cupo_maximo""",
        """CASE WHEN n_nationkey = 23 THEN -1.0D WHEN n_nationkey <> 6 THEN
           n_regionkey * 1000.0D END AS tarifa_diaria""",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "donaciones": donations(spark, sf_dir),
        "gastos": expenses(spark, sf_dir),
        "donantes": donors(spark, sf_dir),
        "casos": cases(spark, sf_dir),
        "proveedores": suppliers(spark, sf_dir),
        "hogar_de_paso": homes(spark, sf_dir),
    }
