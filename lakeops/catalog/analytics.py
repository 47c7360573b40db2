"""Joins, aggregates, windows, sorting and unions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import conform
from ..functions.dates import days_since
from ..functions.numbers import mean, total
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as Wn
from ..operators.calendar import calendar_span, with_calendar
from ..operators.reconcile import stack
from ..plans import bindings as B
from ..plans import gold as G
from ..session import scratch_path
from . import query

def _sum(col):
    return f"CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


def _orders(spark, sf):
    return B.table(spark, sf, "orders")


def _lines(spark, sf):
    return B.table(spark, sf, "lineitem")


# Joins -----------------------------------------------------------------------------------


@query(
    "jon_fact_dim",
    """SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20)
       ON o_custkey = c_custkey""",
)
def _(spark, sf):
    donors = B.table(spark, sf, "customer").filter("c_nationkey < 20").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    facts = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice")
    return J.lookup_join(facts, donors, ["o_custkey"])


@query(
    "jon_two_dims",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, s_name, p_brand FROM lineitem
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey""",
)
def _(spark, sf):
    facts = _lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey", "l_partkey"
    )
    supplier = B.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    part = B.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    out = J.lookup_join(facts, supplier, ["l_suppkey"])
    return J.lookup_join(out, part, ["l_partkey"]).drop("l_suppkey", "l_partkey")


@query(
    "jon_dim_aggregate",
    f"""SELECT c_custkey, c_name, t AS total, n FROM customer LEFT JOIN
        (SELECT o_custkey, {_sum('o_totalprice')} AS t, count(*) AS n FROM orders
         WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON c_custkey = o_custkey""",
)
def _(spark, sf):
    per = A.amount_stats(
        _orders(spark, sf).filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey"),
        ["c_custkey"],
        "o_totalprice",
        "o_orderkey",
        {"total": "total", "count": "n"},
        scale=B.CENTS,
    )
    return B.table(spark, sf, "customer").select("c_custkey", "c_name").join(per, "c_custkey", "left")


@query(
    "jon_calendar_role",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio_pedido,
              strftime(o_orderdate, '%Y-%m') AS anio_mes_pedido,
              year(o_orderdate) || '-T' || quarter(o_orderdate) AS anio_trimestre_pedido,
              CAST(week(o_orderdate) AS INTEGER) AS semana_pedido FROM orders""",
)
def _(spark, sf):
    orders = _orders(spark, sf)
    calendar = with_calendar(calendar_span(orders, "o_orderdate"))
    attributes = [("y", "anio"), ("anio_mes", "anio_mes"), ("anio_trimestre", "anio_trimestre"), ("semana_iso", "semana")]
    return J.calendar_join(
        orders.select("o_orderkey", "o_orderdate"), "o_orderdate", calendar, "pedido", attributes
    ).drop("o_orderdate")


@query(
    "jon_anti",
    """SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem
       WHERE l_partkey = p_partkey AND l_linestatus = 'F' AND l_quantity < 10)""",
)
def _(spark, sf):
    bought = _lines(spark, sf).filter("l_linestatus = 'F' AND l_quantity < 10")
    part = B.table(spark, sf, "part").select("p_partkey", "p_name")
    return J.missing_rows(part, bought.withColumnRenamed("l_partkey", "p_partkey"), ["p_partkey"])


# Aggregates ------------------------------------------------------------------------------


@query(
    "agg_donor",
    f"""SELECT o_custkey, {_sum('o_totalprice')} AS total_donado, count(*) AS num_donaciones,
        {_sum('o_totalprice')} / count(*) AS promedio, CAST(min(o_orderdate) AS DATE) AS primera,
        CAST(max(o_orderdate) AS DATE) AS ultima, max(o_totalprice) AS maximo,
        min(o_totalprice) AS minimo FROM orders GROUP BY o_custkey""",
)
def _(spark, sf):
    rows = _orders(spark, sf).withColumn("dia", F.to_date("o_orderdate"))
    return A.amount_stats(
        rows,
        ["o_custkey"],
        "o_totalprice",
        "o_orderkey",
        {"total": "total_donado", "count": "num_donaciones", "mean": "promedio",
         "first": "primera", "last": "ultima", "max": "maximo", "min": "minimo"},
        date="dia",
        scale=B.CENTS,
    )


@query(
    "agg_case",
    f"""SELECT l_partkey, {_sum('l_extendedprice')} AS costo_total, count(*) AS num_gastos,
        {_sum('l_extendedprice')} / count(*) AS promedio, max(l_extendedprice) AS maximo
        FROM lineitem GROUP BY l_partkey""",
)
def _(spark, sf):
    return A.amount_stats(
        _lines(spark, sf),
        ["l_partkey"],
        "l_extendedprice",
        "l_orderkey",
        {"total": "costo_total", "count": "num_gastos", "mean": "promedio", "max": "maximo"},
        scale=B.CENTS,
    )


@query(
    "agg_supplier",
    f"""SELECT l_suppkey, {_sum('l_extendedprice')} AS total, count(*) AS num,
        {_sum('l_extendedprice')} / count(*) AS promedio, CAST(max(l_shipdate) AS DATE) AS ultimo
        FROM lineitem GROUP BY l_suppkey""",
)
def _(spark, sf):
    return A.amount_stats(
        _lines(spark, sf).withColumn("dia", F.to_date("l_shipdate")),
        ["l_suppkey"],
        "l_extendedprice",
        "l_orderkey",
        {"total": "total", "count": "num", "mean": "promedio", "last": "ultimo"},
        date="dia",
        scale=B.CENTS,
    )


@query(
    "agg_conditional",
    f"""SELECT l_suppkey, count(*) FILTER (WHERE l_linestatus = 'F') AS pagados,
        count(*) FILTER (WHERE l_linestatus <> 'F') AS abiertos,
        {_sum("CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END")} AS devuelto
        FROM lineitem GROUP BY l_suppkey""",
)
def _(spark, sf):
    paid = F.col("l_linestatus") == "F"
    return _lines(spark, sf).groupBy("l_suppkey").agg(
        F.count_if(paid).alias("pagados"),
        F.count_if(~paid).alias("abiertos"),
        A.amount_where(F.col("l_returnflag") == "R", F.col("l_extendedprice"), B.CENTS).alias("devuelto"),
    )


@query(
    "agg_multi_distinct",
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
              count(DISTINCT CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END) AS parts,
              count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_orderkey) AS orders
       FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return _lines(spark, sf).groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(
        F.countDistinct(F.expr("CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END")).alias("parts"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.countDistinct("l_orderkey").alias("orders"),
    )


@query(
    "agg_distinct_bitmaps",
    """SELECT 'month' AS span, CAST(date_trunc('month', l_shipdate) AS DATE) AS first_day, count(DISTINCT l_partkey) AS parts,
         count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 2
       UNION ALL SELECT 'year', CAST(date_trunc('year', l_shipdate) AS DATE), count(DISTINCT l_partkey),
         count(DISTINCT l_suppkey), count(DISTINCT l_orderkey) FROM lineitem GROUP BY 2""",
)
def _(spark, sf):
    """Exact distinct counts by month, and by year from the same bitmaps, which are stored in between."""
    names = {"l_partkey": "parts", "l_suppkey": "suppliers", "l_orderkey": "orders"}
    rows = _lines(spark, sf).withColumn("month", F.to_date(F.date_trunc("month", "l_shipdate")))
    path = scratch_path(spark, "bitmaps")
    A.distinct_bitmaps(rows, ["month"], list(names)).write.parquet(path)
    kept = spark.read.parquet(path)
    spans = [("month", kept), ("year", kept.withColumn("month", F.to_date(F.date_trunc("year", "month"))))]
    return stack([A.bitmap_counts(df, ["month"], names).select(F.lit(s).alias("span"), F.col("month").alias("first_day"), *names.values()) for s, df in spans])


@query(
    "agg_monthly",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
        {_sum('o_totalprice')} AS total_donaciones, count(*) AS cantidad_donaciones,
        {_sum('o_totalprice')} / count(*) AS promedio_donacion
        FROM orders GROUP BY 1, 2 ORDER BY 1, 2""",
)
def _(spark, sf):
    return A.monthly_rollup(_orders(spark, sf), "o_orderdate", "o_totalprice", "o_orderkey", B.CENTS)


@query(
    "agg_global",
    f"""SELECT count(*) AS n, {_sum('l_extendedprice')} AS total, min(l_shipdate) AS first_ship,
        max(l_extendedprice) AS largest FROM lineitem""",
)
def _(spark, sf):
    return _lines(spark, sf).agg(
        F.count(F.lit(1)).alias("n"),
        total(F.col("l_extendedprice"), B.CENTS).alias("total"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_extendedprice").alias("largest"),
    )


@query(
    "agg_dirty_amounts",
    """SELECT o_orderstatus, count(*) AS row_count, CAST(sum(CASE WHEN o_orderkey % 11 > 1 THEN
         CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS amount,
         count(*) FILTER (WHERE o_orderkey % 11 = 0) AS unreadable FROM orders GROUP BY 1""",
)
def _(spark, sf):
    """NaN and infinite amounts: the typed registry drops the first, exact sums skip both."""
    dirty = _orders(spark, sf).selectExpr(
        "o_orderstatus",
        """CASE o_orderkey % 11 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity')
           ELSE o_totalprice END AS monto""",
    )
    amount = T.StructType([T.StructField("monto", T.DoubleType())])
    return conform(dirty, amount).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        total(F.col("monto"), B.CENTS).alias("amount"),
        F.count_if(F.col("monto").isNull()).alias("unreadable"),
    )


# Windows ---------------------------------------------------------------------------------

_ENTITY_SQL = f"""SELECT o_orderkey, o_custkey, count(*) OVER w AS frecuencia,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS promedio,
  max(o_totalprice) OVER w AS maximo, min(o_totalprice) OVER w AS minimo
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 >= 4 THEN o_custkey WHEN o_orderkey % 10 > 0
        THEN 541 END AS o_custkey, o_totalprice FROM orders)
  WINDOW w AS (PARTITION BY o_custkey)"""


def _entity_input(spark, sf):
    """A third of all orders moved to one customer, a tenth to none."""
    return _orders(spark, sf).select(
        "o_orderkey",
        F.expr(
            """CASE WHEN o_orderkey % 10 >= 4 THEN o_custkey WHEN o_orderkey % 10 > 0
               THEN 541 END"""
        ).alias("o_custkey"),
        "o_totalprice",
    )


@query("win_entity_metrics", _ENTITY_SQL)
def _(spark, sf):
    amount = F.col("o_totalprice")
    metrics = {
        "frecuencia": F.count("o_orderkey"),
        "total": total(amount, B.CENTS),
        "promedio": mean(amount, B.CENTS),
        "maximo": F.max(amount),
        "minimo": F.min(amount),
    }
    out = Wn.entity_metrics(_entity_input(spark, sf), ["o_custkey"], metrics, salt=["o_orderkey"])
    return out.drop("o_totalprice")


@query(
    "win_recency",
    """SELECT o_orderkey, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS
       recencia_fila, CAST(DATE '2002-01-01' - CAST(max(o_orderdate) OVER (PARTITION BY o_custkey)
       AS DATE) AS INTEGER) AS recencia_donante FROM orders""",
)
def _(spark, sf):
    rows = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    out = Wn.entity_metrics(rows, ["o_custkey"], {"ultima": F.max("o_orderdate")}, salt=["o_orderkey"])
    return out.select(
        "o_orderkey",
        days_since(F.col("o_orderdate"), B.AS_OF).alias("recencia_fila"),
        days_since(F.col("ultima"), B.AS_OF).alias("recencia_donante"),
    )


def _months(spark, sf, gap=False):
    month = F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")
    return (
        _orders(spark, sf)
        .filter(F.expr("month(o_orderdate) <> 5") if gap else F.lit(True))
        .groupBy(month)
        .agg(total(F.col("o_totalprice"), B.CENTS).alias("income"))
    )


_MONTHS = """months AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS income FROM orders GROUP BY 1)"""
# A month of the year is missing: the trailing window counts rows, not months.
_GAPS = _MONTHS.replace(" GROUP BY 1", " WHERE month(o_orderdate) <> 5 GROUP BY 1")


@query(
    "win_running_balance",
    f"""WITH {_MONTHS} SELECT month, CAST(income AS DOUBLE) AS income, CAST(sum(income) OVER
        (ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM months""",
)
def _(spark, sf):
    return _months(spark, sf).withColumn(
        "running", Wn.running_total(F.col("income"), "month", B.CENTS)
    )


@query(
    "win_trailing_three",
    f"""WITH {_GAPS} SELECT month, CAST(sum(income) OVER (ORDER BY month ROWS BETWEEN 2
        PRECEDING AND CURRENT ROW) AS DOUBLE) AS trailing FROM months""",
)
def _(spark, sf):
    return _months(spark, sf, gap=True).select(
        "month", Wn.trailing_total(F.col("income"), "month", scale=B.CENTS).alias("trailing")
    )


# Sorting and unions ----------------------------------------------------------------------


@query(
    "srt_topk_months",
    f"""WITH {_MONTHS} SELECT month, CAST(CAST(trunc(income) AS BIGINT) AS BIGINT) AS income
        FROM months ORDER BY month DESC LIMIT 6""",
)
def _(spark, sf):
    return (
        _months(spark, sf)
        .select("month", F.col("income").cast("long").alias("income"))
        .orderBy(F.desc("month"))
        .limit(6)
    )


@query(
    "set_movements",
    f"""SELECT strftime(CAST(date_trunc('month', d) AS DATE), '%Y-%m') AS anio_mes, es_gasto,
        count(*) AS n, count(id_donante) AS con_donante, count(id_proveedor) AS con_proveedor,
        CAST(sum(CAST(monto AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM (SELECT o_orderdate AS d, o_custkey AS id_donante, NULL AS id_proveedor,
                     o_totalprice AS monto, FALSE AS es_gasto FROM orders
              UNION ALL SELECT l_shipdate, NULL, l_suppkey, l_extendedprice, TRUE FROM lineitem)
        GROUP BY 1, 2""",
)
def _(spark, sf):
    income = _orders(spark, sf).selectExpr(
        "o_custkey AS id_donante",
        "o_totalprice AS monto",
        "date_format(o_orderdate, 'yyyy-MM') AS anio_mes",
        "'x' AS categoria_monto",
    )
    spend = _lines(spark, sf).selectExpr(
        "l_suppkey AS id_proveedor",
        "l_partkey AS id_caso",
        "l_extendedprice AS monto",
        "date_format(l_shipdate, 'yyyy-MM') AS anio_mes",
        "false AS sobrepresupuesto",
        "'x' AS categoria_monto",
    )
    return (
        G.movements(income, spend)
        .groupBy(F.date_format("anio_mes", "yyyy-MM").alias("anio_mes"), "es_gasto")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("id_donante").alias("con_donante"),
            F.count("id_proveedor").alias("con_proveedor"),
            total(F.col("monto"), B.CENTS).alias("total"),
        )
    )


@query(
    "set_union_by_position",
    "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def _(spark, sf):
    left = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return left.union(B.table(spark, sf, "supplier").select("s_suppkey", "s_name"))
