"""Filters, casts, cleaning, deduplication and scalar functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import buckets as K
from ..functions import casts as C
from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..operators import dedup, filters
from ..operators.joins import lookup_join
from ..operators.reconcile import preview
from ..plans import bindings as B
from ..plans import rules as R
from ..session import scratch_path
from ..sinks import writers as W
from . import query


def _t(name):
    return lambda spark, sf: B.table(spark, sf, name)


_orders, _lineitem, _customer, _part, _supplier, _events, _nation = map(
    _t, ["orders", "lineitem", "customer", "part", "supplier", "events", "nation"]
)

# Projections and filters -----------------------------------------------------------------


@query(
    "prj_rename_replace",
    """SELECT o_orderkey AS id_donacion, o_custkey AS id_donante, o_totalprice AS monto,
              upper(o_orderpriority) || '/' || o_orderstatus AS clave FROM orders""",
)
def _(spark, sf):
    return _orders(spark, sf).withColumns(
        {"clave": F.concat_ws("/", F.upper("o_orderpriority"), "o_orderstatus")}
    ).select(
        F.col("o_orderkey").alias("id_donacion"),
        F.col("o_custkey").alias("id_donante"),
        F.col("o_totalprice").alias("monto"),
        "clave",
    )


@query(
    "prj_preview_five",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem",
)
def _(spark, sf):
    return preview(_lineitem(spark, sf), 5)


@query("flt_status", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    return _orders(spark, sf).filter(filters.in_status("o_orderstatus", "F")).select("o_orderkey")


@query(
    "flt_required",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE NOT (l_linenumber = 7 AND l_tax = 0) AND l_suppkey % 40 <> 0""",
)
def _(spark, sf):
    rows = _lineitem(spark, sf).withColumns(
        {
            "monto": F.expr("CASE WHEN NOT (l_linenumber = 7 AND l_tax = 0) THEN l_extendedprice END"),
            "id_proveedor": F.expr("CASE WHEN l_suppkey % 40 <> 0 THEN l_suppkey END"),
        }
    )
    return filters.require(rows, "monto", "id_proveedor").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "flt_positive_dated",
    "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0 AND s_suppkey % 4 <> 0",
)
def _(spark, sf):
    rows = _supplier(spark, sf).withColumn(
        "fecha", F.expr("CASE WHEN s_suppkey % 4 <> 0 THEN DATE '2000-01-01' END")
    )
    return filters.positive_and_dated(rows, "s_acctbal", "fecha").select("s_suppkey", "s_acctbal")


@query(
    "flt_month_slice",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 12""",
)
def _(spark, sf):
    return filters.month_slice(_orders(spark, sf), "o_orderdate", "1998-12").select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "flt_partition_month",
    """SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1999 AND month(o_orderdate) = 2""",
)
def _(spark, sf):
    path = scratch_path(spark, "months")
    W.overwrite_all_partitions(W.with_partitions(_orders(spark, sf), "o_orderdate"), path)
    return filters.partition_month_slice(spark.read.parquet(path), "1999-02").select("o_orderkey")


@query(
    "flt_range_and_set",
    """SELECT p_partkey, p_type, p_size FROM part WHERE p_size BETWEEN 10 AND 20
       AND p_type IN ('PROMO', 'LARGE')""",
)
def _(spark, sf):
    return _part(spark, sf).filter(
        F.col("p_size").between(10, 20) & F.col("p_type").isin("PROMO", "LARGE")
    ).select("p_partkey", "p_type", "p_size")


@query(
    "flt_sql_text",
    "SELECT event_id FROM events WHERE value > 50 AND event_type = 'purchase'",
)
def _(spark, sf):
    return _events(spark, sf).filter("value > 50 AND event_type = 'purchase'").select("event_id")


@query(
    "flt_blank",
    "SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 4)",
)
def _(spark, sf):
    pais = F.expr("CASE c_nationkey WHEN 3 THEN '   ' WHEN 4 THEN NULL ELSE 'x' END")
    return _customer(spark, sf).filter(X.is_blank(pais)).select("c_custkey")


# Casts -----------------------------------------------------------------------------------


@query(
    "cst_mixed_timestamps",
    """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE ts END AS at FROM events""",
)
def _(spark, sf):
    raw = F.expr(
        """CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '2024-13-01' WHEN 2 THEN
           cast(unix_micros(ts::timestamp) AS string) WHEN 3 THEN
           concat(replace(cast(ts AS string), ' ', 'T'), 'Z') ELSE cast(ts AS string) END"""
    )
    # Read as an instant, shown zone-free in UTC, whatever zone the session runs in.
    return _events(spark, sf).select(
        "event_id",
        C.to_utc_naive(
            F.when(F.col("event_id") % 5 == 4, F.concat(raw, F.lit("+00:00"))).otherwise(raw),
            _string(),
        ).alias("at"),
    )


def _string():
    from pyspark.sql.types import StringType

    return StringType()


@query(
    "cst_ids_and_numbers",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS as_long,
              CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_totalprice END AS as_double,
              CAST(CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderkey % 100 END AS INTEGER)
              AS as_int
       FROM orders""",
)
def _(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey",
        C.to_long(
            F.expr("CASE WHEN o_orderkey % 3 = 0 THEN double('NaN') ELSE double(o_custkey) END")
        ).alias("as_long"),
        C.to_double(
            F.expr("CASE WHEN o_orderkey % 3 = 1 THEN 'abc' ELSE string(o_totalprice) END")
        ).alias("as_double"),
        C.to_int(
            F.expr("CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE concat(o_orderkey % 100, '.0') END")
        ).alias("as_int"),
    )


@query(
    "cst_month_text",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day FROM orders",
)
def _(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey", C.month_text_to_date(D.month_key(F.col("o_orderdate"))).alias("first_day")
    )


# Cleaning --------------------------------------------------------------------------------

_PAYMENT_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN ' Transferencia ' WHEN '2-HIGH' THEN
    'TRANSFER banco' WHEN '3-MEDIUM' THEN 'Tarjeta Visa' WHEN '5-LOW' THEN ' Efectivo' END"""


@query(
    "cln_payment_category",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'transferencia'
              WHEN '2-HIGH' THEN 'transferencia' WHEN '3-MEDIUM' THEN 'tarjeta'
              WHEN '5-LOW' THEN 'efectivo' ELSE 'nequi' END AS medio_pago FROM orders""",
)
def _(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey",
        X.pattern_category(F.expr(_PAYMENT_TEXT), R.DONATION_PAYMENT, R.PAYMENT_MISSING).alias(
            "medio_pago"
        ),
    )


@query(
    "cln_payment_narrow",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'transferencia'
              WHEN '2-HIGH' THEN 'transfer banco' WHEN '3-MEDIUM' THEN 'tarjeta'
              WHEN '5-LOW' THEN 'efectivo' ELSE 'nequi' END AS medio_pago FROM orders""",
)
def _(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey",
        X.pattern_category(F.expr(_PAYMENT_TEXT), R.EXPENSE_PAYMENT, R.PAYMENT_MISSING).alias(
            "medio_pago"
        ),
    )


@query(
    "cln_status_map",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (0, 1, 2, 3, 4, 5, 6) THEN 'completada'
              WHEN o_orderkey % 11 IN (7, 8, 9) THEN 'fallida' ELSE 'pendiente' END AS estado
       FROM orders""",
)
def _(spark, sf):
    word = F.element_at(
        F.array(
            *[F.lit(w) for w in (None, " Aprobada", "CONFIRMADA", "confirmado ", "Exitosa",
                                 "exitoso", "Completada", "fallida", " RECHAZADA ", "error", "otro")]
        ),
        (F.col("o_orderkey") % 11 + 1).cast("int"),
    )
    return _orders(spark, sf).select(
        "o_orderkey",
        X.word_category(word, R.DONATION_STATUS, R.STATUS_OPEN, R.DONATION_DONE).alias("estado"),
    )


@query(
    "cln_status_expense",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
              CASE l_linestatus WHEN 'F' THEN 'pagado' ELSE 'pendiente' END AS estado
       FROM lineitem""",
)
def _(spark, sf):
    word = F.expr("CASE l_linestatus WHEN 'F' THEN ' Pagado' ELSE 'completada' END")
    return _lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        X.word_category(word, R.EXPENSE_STATUS, R.STATUS_OPEN, R.EXPENSE_DONE).alias("estado"),
    )


@query(
    "cln_defaults_trim",
    """SELECT c_custkey, CASE WHEN c_custkey % 40 = 0 THEN 'ANONIMO' ELSE upper(c_name) END
              AS donante, lower(c_mktsegment) AS ciudad,
              CASE WHEN c_custkey % 10 = 0 THEN 541 ELSE c_custkey END AS id_donante
       FROM customer""",
)
def _(spark, sf):
    c = _customer(spark, sf).selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 40 <> 0 THEN concat(' ', c_name, '  ') END AS name",
        "concat(c_mktsegment, ' ') AS seg",
        "CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS k",
    )
    return c.select(
        "c_custkey",
        X.or_default(X.upper_trim(F.col("name")), R.DONOR_NAME).alias("donante"),
        X.or_default(X.lower_trim(F.col("seg")), R.CITY).alias("ciudad"),
        X.or_default(F.col("k"), R.NO_DONOR).alias("id_donante"),
    )


@query(
    "cln_initcap_country",
    """SELECT c_custkey, CASE WHEN c_nationkey IN (3, 4) THEN 'Colombia' ELSE
              array_to_string(list_transform(string_split(lower(replace(n_name, '_', ' ')), ' '),
              lambda x: upper(x[1]) || x[2:]), ' ') END AS pais
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, sf):
    raw = B.donors(spark, sf)
    return raw.select(
        F.col("id_donante").alias("c_custkey"),
        X.title_or_default(F.col("pais"), R.COUNTRY).alias("pais"),
    )


@query(
    "cln_fallback_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE)
              ELSE CAST(o_orderdate AS DATE) + 7 END AS created_at FROM orders""",
)
def _(spark, sf):
    return _orders(spark, sf).select(
        "o_orderkey",
        F.coalesce(
            F.expr("CASE WHEN o_orderkey % 2 = 0 THEN date(o_orderdate) END"),
            F.date_add("o_orderdate", 7),
        ).alias("created_at"),
    )


@query(
    "cln_constants_audit",
    """SELECT p_partkey, 'no urgente' AS estado, 'raw_casos' AS fuente,
              DATE '2002-01-01' AS dia_ingesta FROM part""",
)
def _(spark, sf):
    return _part(spark, sf).select(
        "p_partkey",
        F.lit(R.CASE_STATUS).alias("estado"),
        F.lit("raw_casos").alias("fuente"),
        F.to_date(D.as_of_instant(B.AS_OF)).alias("dia_ingesta"),
    )


@query(
    "cln_null_amount",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice END
              AS monto FROM lineitem""",
)
def _(spark, sf):
    return _lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        X.or_default(F.expr("CASE WHEN l_tax <> 0 THEN l_extendedprice END"), 0.0).alias("monto"),
    )


@query(
    "cln_zero_fill",
    """SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN
              (SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)
              ON c_custkey = o_custkey GROUP BY c_custkey""",
)
def _(spark, sf):
    counts = (
        _orders(spark, sf)
        .filter("o_orderstatus = 'P' AND o_totalprice > 400000")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("o_orderkey").alias("n"))
    )
    return _customer(spark, sf).select("c_custkey").join(counts, "c_custkey", "left").fillna(0, ["n"])


# Deduplication ---------------------------------------------------------------------------


@query(
    "ddp_latest_lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
       FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def _(spark, sf):
    rows = _lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return dedup.latest_by_key(
        rows,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate"],
        ["l_extendedprice", "l_partkey", "l_suppkey"],
    )


@query(
    "ddp_latest_event_per_user",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf):
    latest = dedup.latest_by_key(_events(spark, sf), ["user_id"], ["ts"], ["event_id"])
    return latest.select("user_id", "event_id", "event_type", "value")


@query(
    "ddp_order_fallback",
    """SELECT l_orderkey, max(l_shipdate) AS created_at FROM lineitem GROUP BY l_orderkey""",
)
def _(spark, sf):
    rows = _lineitem(spark, sf).select("l_orderkey", F.col("l_shipdate").alias("created_at"))
    return dedup.latest_by_first_available(rows, ["l_orderkey"])


@query(
    "ddp_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, sf):
    return dedup.duplicate_keys(_lineitem(spark, sf), ["l_orderkey", "l_linenumber"], "copies")


# Scalar functions ------------------------------------------------------------------------


@query(
    "fun_text",
    """SELECT p_partkey, upper(trim(p_name)) AS up, lower(p_type) AS low,
              lpad(CAST(p_size AS VARCHAR), 2, '0') AS padded,
              p_name LIKE '%ring%' AS has_ring, contains(p_brand, '#1') AS has_one,
              regexp_matches(p_brand, '^Brand#[0-9]$') AS short_brand,
              p_size || '-T' || (p_size % 4) AS tag, printf('%d-%02d', p_partkey, p_size) AS fmt
       FROM part""",
)
def _(spark, sf):
    return _part(spark, sf).select(
        "p_partkey",
        X.upper_trim(F.col("p_name")).alias("up"),
        X.lower_trim(F.col("p_type")).alias("low"),
        D.two_digits(F.col("p_size")).alias("padded"),
        F.col("p_name").like("%ring%").alias("has_ring"),
        F.col("p_brand").contains("#1").alias("has_one"),
        F.col("p_brand").rlike("^Brand#[0-9]$").alias("short_brand"),
        F.concat(F.col("p_size"), F.lit("-T"), F.col("p_size") % 4).alias("tag"),
        F.format_string("%d-%02d", "p_partkey", "p_size").alias("fmt"),
    )


@query(
    "fun_dates",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
              CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(day(o_orderdate) AS INTEGER) AS d,
              CAST(week(o_orderdate) AS INTEGER) AS wk,
              CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
              dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name,
              strftime(o_orderdate, '%Y-%m') AS month_key,
              CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days,
              round((2002 - year(o_orderdate)) * 12 + 1 - month(o_orderdate)
                    + CASE WHEN day(o_orderdate) = 1 THEN 0 ELSE (1 - day(o_orderdate)) / 31.0 END,
                    6) AS age_months
       FROM orders""",
)
def _(spark, sf):
    d = F.to_date("o_orderdate")
    return _orders(spark, sf).select(
        "o_orderkey",
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.dayofmonth(d).alias("d"),
        F.weekofyear(d).alias("wk"),
        F.dayofweek(d).alias("dow"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        D.month_key(d).alias("month_key"),
        D.days_since(d, B.AS_OF).alias("age_days"),
        F.round(D.months_since(d, B.AS_OF), 6).alias("age_months"),
    )


@query(
    "fun_numbers",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, round(ln(1 + l_extendedprice), 6) AS log_amount,
              l_extendedprice / nullif(l_tax, 0) AS per_tax,
              CASE WHEN l_tax > 0 THEN l_quantity / l_tax ELSE 0.0 END AS per_tax_or_zero,
              CASE WHEN l_quantity > 0 THEN l_discount * 100 / l_quantity ELSE 0.0 END AS pct
       FROM lineitem""",
)
def _(spark, sf):
    return _lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.round(N.log_amount(F.col("l_extendedprice")), 6).alias("log_amount"),
        N.ratio(F.col("l_extendedprice"), F.col("l_tax")).alias("per_tax"),
        N.ratio_or_zero(F.col("l_quantity"), F.col("l_tax")).alias("per_tax_or_zero"),
        N.percentage(F.col("l_discount"), F.col("l_quantity")).alias("pct"),
    )


# Buckets ---------------------------------------------------------------------------------


@query(
    "bkt_donation_amount",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'Bajo' WHEN o_totalprice < 200000
              THEN 'Medio' ELSE 'Alto' END AS categoria_monto,
              CASE WHEN o_totalprice >= 400000 THEN 'critica' WHEN o_totalprice >= 200000
              THEN 'media' ELSE 'pequena' END AS tamano_donacion,
              o_totalprice > 400000 AS es_donacion_critica FROM orders""",
)
def _(spark, sf):
    amount = F.col("o_totalprice")
    return _orders(spark, sf).select(
        "o_orderkey",
        K.bucket(amount, *R.DONATION_AMOUNT).alias("categoria_monto"),
        K.bucket(amount, *B.SIZE).alias("tamano_donacion"),
        K.flag(amount > B.CRITICAL).alias("es_donacion_critica"),
    )


@query(
    "bkt_donor_tier",
    """SELECT o_custkey, CASE WHEN t > 2000000 THEN 'oro' WHEN t > 700000 THEN 'plata'
              WHEN t > 200000 THEN 'bronce' ELSE 'basico' END AS tier, n >= 3 AS recurrent
       FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t, count(*) AS n
             FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)""",
)
def _(spark, sf):
    totals = (
        _orders(spark, sf)
        .filter("o_orderstatus = 'F'")
        .groupBy("o_custkey")
        .agg(N.total(F.col("o_totalprice"), B.CENTS).alias("t"), F.count(F.lit(1)).alias("n"))
    )
    return totals.select(
        "o_custkey",
        K.bucket(F.col("t"), *R.DONOR_TIER).alias("tier"),
        K.flag(F.col("n") >= R.DONOR_RECURRENT).alias("recurrent"),
    )


@query(
    "bkt_expense_amount",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_extendedprice < 25000 THEN
              'Pequeño' WHEN l_extendedprice BETWEEN 25000 AND 75000 THEN 'Mediano' ELSE 'Grande'
              END AS categoria_monto FROM lineitem""",
)
def _(spark, sf):
    return _lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        K.bucket(F.col("l_extendedprice"), *B.EXPENSE_AMOUNT).alias("categoria_monto"),
    )


@query(
    "bkt_case_cost",
    """SELECT l_partkey, CASE WHEN t > 1000000 THEN 'Critico' WHEN t > 500000 THEN 'Alto'
              WHEN t > 100000 THEN 'Medio' ELSE 'Bajo' END AS categoria_costo,
              t > 1000000 AS es_caso_alto_costo
       FROM (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t FROM lineitem
             GROUP BY l_partkey)""",
)
def _(spark, sf):
    t = F.col("t")
    return (
        _lineitem(spark, sf)
        .groupBy("l_partkey")
        .agg(N.total(F.col("l_extendedprice"), B.CENTS).alias("t"))
        .select(
            "l_partkey",
            K.bucket(t, *R.CASE_COST).alias("categoria_costo"),
            K.flag(t > R.CASE_HIGH_COST).alias("es_caso_alto_costo"),
        )
    )


@query(
    "bkt_supplier",
    """SELECT l_suppkey, CASE WHEN t > 33000000 THEN 'Socio Estratégico' WHEN t > 31000000 THEN
              'Proveedor Frecuente' ELSE 'Transaccional' END AS importancia,
              CASE l_suppkey % 5 WHEN 0 THEN 'Servicios Veterinarios' WHEN 1 THEN 'Insumos'
              WHEN 2 THEN 'Logística' ELSE 'General' END AS categoria
       FROM (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t FROM lineitem
             GROUP BY l_suppkey)""",
)
def _(spark, sf):
    kind = F.expr(
        """CASE l_suppkey % 5 WHEN 0 THEN 'Medico Veterinario' WHEN 1 THEN 'INSUMOS' WHEN 2 THEN
           'transporte urbano' WHEN 3 THEN 'otro' END"""
    )
    patterns, otherwise = R.SUPPLIER_CATEGORY
    return (
        _lineitem(spark, sf)
        .groupBy("l_suppkey")
        .agg(N.total(F.col("l_extendedprice"), B.CENTS).alias("t"))
        .select(
            "l_suppkey",
            K.bucket(F.col("t"), *B.SUPPLIER_IMPORTANCE).alias("importancia"),
            X.pattern_category(kind, patterns, otherwise=otherwise).alias("categoria"),
        )
    )


@query(
    "bkt_ratios",
    """SELECT n_nationkey, CASE WHEN o > 0.85 THEN 'Alta' WHEN o BETWEEN 0.40 AND 0.85 THEN
              'Media' ELSE 'Baja' END AS ocupacion, CASE WHEN f > 0.7 THEN 'Alta rotación'
              WHEN f BETWEEN 0.3 AND 0.7 THEN 'Media' ELSE 'Baja rotación' END AS rotacion
       FROM (SELECT c_nationkey AS n_nationkey, sum(CASE WHEN c_acctbal >= 5000 THEN 1 ELSE 0 END)
             / nullif(CAST(c_nationkey AS DOUBLE) * 4, 0) AS o, avg(CASE WHEN c_mktsegment =
             'BUILDING' THEN 1.0 ELSE 0.0 END) AS f FROM customer GROUP BY c_nationkey)""",
)
def _(spark, sf):
    active = F.count_if(F.col("c_acctbal") >= 5000)
    done = F.count_if(F.col("c_mktsegment") == "BUILDING")
    return (
        _customer(spark, sf)
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(
            N.ratio(active, F.first("c_nationkey") * 4).alias("o"),
            N.ratio(done, F.count(F.lit(1))).alias("f"),
        )
        .select(
            "n_nationkey",
            K.bucket(F.col("o"), *R.OCCUPANCY).alias("ocupacion"),
            K.bucket(F.col("f"), *R.TURNOVER).alias("rotacion"),
        )
    )


@query(
    "bkt_tristate_budget",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN p_partkey IS NULL OR
              p_size % 7 = 0 THEN NULL ELSE l_extendedprice > p_retailprice * 50 END
              AS sobrepresupuesto FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def _(spark, sf):
    budget = _part(spark, sf).select(
        F.col("p_partkey").alias("l_partkey"),
        F.expr("CASE WHEN p_size % 7 <> 0 THEN p_retailprice * 50 END").alias("budget"),
    )
    rows = lookup_join(_lineitem(spark, sf), budget, ["l_partkey"])
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        K.exceeds(F.col("l_extendedprice"), F.col("budget")).alias("sobrepresupuesto"),
    )
