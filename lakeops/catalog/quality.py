"""Rules, quarantine and audits on whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import joins
from ..operators import quality as dq
from ..operators import reconcile as RC
from ..plans import bindings as B
from ..plans import rules as R
from ..session import scratch_path
from ..sinks import versioned
from ..sinks import writers as W
from . import query


def _tagged_customers(spark, sf):
    """Customers with several rules per row; one of them on a placeholder value."""
    rows = B.table(spark, sf, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.expr(
            """CASE c_custkey % 6 WHEN 0 THEN 'desconocido' WHEN 1 THEN 'sin correo'
               ELSE concat('c', c_custkey, '@mail.org') END"""
        ).alias("correo"),
        F.expr("CASE WHEN c_custkey % 90 <> 0 THEN c_custkey END").alias("id_donante"),
        F.expr("date_add(DATE '2009-06-01', cast(c_custkey % 6000 AS int))").alias("alta"),
        F.expr("CASE WHEN c_custkey % 30 = 0 THEN 'anonimo' ELSE c_name END").alias("nombre"),
    )
    return dq.tag(
        rows,
        [
            dq.negative("MONTO_NEGATIVO", "c_acctbal"),
            dq.in_future("FECHA_FUTURA", "alta", dt.date(2012, 1, 1)),
            dq.missing("ID_NULO", "id_donante"),
            dq.before("FECHA_ANTERIOR_A_2010", "alta", R.FIRST_VALID_DAY),
            dq.outside("FECHA_INGRESO_INVALIDA", "alta", R.FIRST_VALID_DAY, dt.date(2012, 6, 1)),
            dq.still_default("NOMBRE_CASO_NULO", "nombre", R.CASE_NAME),
            dq.bad_email("EMAIL_INVALIDO", "correo", R.DONOR_EMAIL),
        ],
    )


_TAGGED = """tagged AS (
  SELECT c_custkey, c_acctbal, list_filter([
    CASE WHEN c_acctbal < 0 THEN 'MONTO_NEGATIVO' END,
    CASE WHEN alta > DATE '2012-01-01' THEN 'FECHA_FUTURA' END,
    CASE WHEN c_custkey % 90 = 0 THEN 'ID_NULO' END,
    CASE WHEN alta < DATE '2010-01-01' THEN 'FECHA_ANTERIOR_A_2010' END,
    CASE WHEN alta < DATE '2010-01-01' OR alta > DATE '2012-06-01'
         THEN 'FECHA_INGRESO_INVALIDA' END,
    CASE WHEN c_custkey % 30 = 0 THEN 'NOMBRE_CASO_NULO' END,
    CASE WHEN c_custkey % 6 = 1 THEN 'EMAIL_INVALIDO' END], lambda x: x IS NOT NULL) AS codes
  FROM (SELECT *, DATE '2009-06-01' + CAST(c_custkey % 6000 AS INTEGER) AS alta FROM customer))
"""


@query(
    "dq_tag_customers",
    f"WITH {_TAGGED} SELECT c_custkey, array_to_string(codes, ',') AS dq_errors FROM tagged",
)
def _(spark, sf):
    return _tagged_customers(spark, sf).select(
        "c_custkey", F.array_join(dq.ERRORS, ",").alias("dq_errors")
    )


@query("dq_valid", f"WITH {_TAGGED} SELECT c_custkey, c_acctbal FROM tagged WHERE len(codes) = 0")
def _(spark, sf):
    return dq.valid_rows(_tagged_customers(spark, sf)).select("c_custkey", "c_acctbal")


@query(
    "dq_quarantine",
    f"""WITH {_TAGGED} SELECT c_custkey, array_to_string(codes, ',') AS dq_errors,
        'run-1' AS run_id, 'customers' AS rule_set FROM tagged WHERE len(codes) > 0""",
)
def _(spark, sf):
    path = scratch_path(spark, "quarantine")
    W.append_quarantine(_tagged_customers(spark, sf), path, "run-1", "customers")
    return spark.read.parquet(path).select(
        "c_custkey", F.array_join(dq.ERRORS, ",").alias("dq_errors"), "run_id", "rule_set"
    )


@query(
    "dq_error_counts",
    f"""WITH {_TAGGED} SELECT error_code, count(*) AS row_count
        FROM (SELECT unnest(codes) AS error_code FROM tagged) GROUP BY error_code""",
)
def _(spark, sf):
    return RC.error_counts(_tagged_customers(spark, sf))


@query(
    "dq_quarantine_report",
    f"""WITH {_TAGGED} SELECT 'clientes' AS table_name, 'customers' AS rule_set, run_id, error_code,
        count(*) AS row_count FROM (SELECT unnest(codes) AS error_code FROM tagged),
        (VALUES ('run-1'), ('run-2')) AS r(run_id) GROUP BY run_id, error_code""",
)
def _(spark, sf):
    root = scratch_path(spark, "report")
    tagged = _tagged_customers(spark, sf)
    for run in ("run-1", "run-2"):
        W.append_quarantine(tagged, f"{root}/quarantine/clientes", run, "customers")
    return RC.quarantine_report(spark, root, ["clientes", "limpios"])


@query(
    "dq_home_rules",
    """SELECT n_nationkey, array_to_string(list_filter([
         CASE WHEN n_nationkey = 24 THEN 'CUPO_NEGATIVO' END,
         CASE WHEN n_nationkey = 23 THEN 'TARIFA_NEGATIVA' END,
         CASE WHEN n_nationkey = 7 THEN 'NOMBRE_HOGAR_NULO' END], lambda x: x IS NOT NULL), ',')
         AS dq_errors FROM nation""",
)
def _(spark, sf):
    from ..plans import silver

    return silver.homes(B.homes(spark, sf), B.AS_OF).select(
        F.col("id_hogar_de_paso").cast("int").alias("n_nationkey"),
        F.array_join(dq.ERRORS, ",").alias("dq_errors"),
    )


@query(
    "dq_bounds",
    """SELECT o_orderkey, o_totalprice > 450000 OR o_totalprice < 2000 AS monto_fuera,
              o_orderdate < TIMESTAMP '1997-01-01' AS fecha_vieja FROM orders""",
)
def _(spark, sf):
    tagged = dq.tag(
        B.table(spark, sf, "orders"),
        [
            dq.amount_bounds("MONTO_FUERA", "o_totalprice", 2_000, 450_000),
            dq.recent_years("FECHA_VIEJA", "o_orderdate", R.RECENT_YEARS, B.AS_OF),
        ],
    )
    return tagged.select(
        "o_orderkey",
        F.array_contains(dq.ERRORS, "MONTO_FUERA").alias("monto_fuera"),
        F.array_contains(dq.ERRORS, "FECHA_VIEJA").alias("fecha_vieja"),
    )


@query(
    "dq_null_profile",
    """SELECT * FROM (SELECT
         count(*) FILTER (WHERE o_orderkey % 10 = 0) AS id_donante,
         count(*) FILTER (WHERE o_orderkey % 7 = 0) AS monto,
         count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS medio_pago,
         count(*) FILTER (WHERE o_orderkey % 17 = 0) AS last_modified_at FROM orders)
       UNPIVOT (null_count FOR column_name IN (id_donante, monto, medio_pago, last_modified_at))""",
)
def _(spark, sf):
    raw = B.donations(spark, sf).withColumn(
        "monto", F.expr("CASE WHEN id_donacion % 7 = 0 THEN double('NaN') ELSE monto END")
    )
    return dq.null_profile(raw, ["id_donante", "monto", "medio_pago", "last_modified_at", "absent"])


@query(
    "dq_range_check",
    """SELECT count(*) FILTER (WHERE year(o_orderdate) NOT BETWEEN 1996 AND 2000) AS bad_year,
              count(*) FILTER (WHERE o_orderkey % 101 = 0) AS not_positive FROM orders""",
)
def _(spark, sf):
    return dq.violations(
        B.donations(spark, sf),
        {
            "bad_year": dq.year_outside("fecha_donacion", 1996, 2000),
            "not_positive": F.col("monto") <= 0,
        },
    )


@query(
    "dq_batch_counters",
    """SELECT count(*) AS "rows", count(*) FILTER (WHERE c_acctbal < 0) AS quarantined
       FROM customer""",
)
def _(spark, sf):
    rows, seen = dq.counted(
        B.table(spark, sf, "customer"),
        "customers",
        quarantined=F.count_if(F.col("c_acctbal") < 0),
    )
    W.write_snapshot(rows, scratch_path(spark, "counted"))
    values = seen.get
    return spark.createDataFrame(
        [(values["rows"], values["quarantined"])], "`rows` long, quarantined long"
    )


_LATEST_LINES = """latest AS (SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC,
  l_partkey DESC, l_suppkey DESC) = 1)"""


@query(
    "dq_reconcile",
    f"""WITH {_LATEST_LINES}, c AS (
          SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem) AS raw_rows,
                 (SELECT count(*) FROM latest) AS silver_rows
          UNION ALL SELECT 'orders', (SELECT count(*) FROM orders),
                 (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')
          UNION ALL SELECT 'nation', 0, 0)
        SELECT *, raw_rows - silver_rows AS delta_rows, CASE WHEN raw_rows > 0
               THEN CAST(silver_rows * 100 AS DOUBLE) / raw_rows ELSE 0.0 END AS retention_pct
        FROM c""",
)
def _(spark, sf):
    orders = B.table(spark, sf, "orders")
    none = B.table(spark, sf, "nation").filter("n_nationkey < 0")
    lines = B.table(spark, sf, "lineitem")  # deduplication keeps one row per key
    return RC.reconcile(
        {
            "lineitem": (lines, lines.select("l_orderkey", "l_linenumber").distinct()),
            "orders": (orders, orders.filter("o_orderstatus = 'F'")),
            "nation": (none, none),
        }
    )


@query(
    "dq_lost_rows",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)""",
)
def _(spark, sf):
    kept = B.table(spark, sf, "orders").filter("o_totalprice > 250000")
    return joins.missing_rows(
        B.table(spark, sf, "customer"),
        kept.withColumnRenamed("o_custkey", "c_custkey"),
        ["c_custkey"],
    ).select("c_custkey", "c_name")


@query(
    "dq_join_preservation",
    """SELECT (SELECT count(*) FROM orders) AS rows_before,
              (SELECT count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey) AS rows_after,
              CAST(0 AS BIGINT) AS duplicate_lookup_keys, TRUE AS preserved""",
)
def _(spark, sf):
    orders = B.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customer = B.table(spark, sf, "customer")
    joined = joins.lookup_join(orders, customer, ["c_custkey"])
    return RC.join_preservation(orders, customer, ["c_custkey"], joined)


@query(
    "dq_three_way",
    f"""WITH {_TAGGED} SELECT 'raw' AS layer, count(*) AS row_count,
          count(*) FILTER (WHERE c_custkey % 90 = 0) AS null_ids FROM customer
        UNION ALL SELECT 'quarantine', count(*), count(*) FILTER (WHERE c_custkey % 90 = 0)
          FROM tagged WHERE len(codes) > 0
        UNION ALL SELECT 'silver', count(*), count(*) FILTER (WHERE c_custkey % 90 = 0)
          FROM tagged WHERE len(codes) = 0""",
)
def _(spark, sf):
    tagged = _tagged_customers(spark, sf)
    raw = tagged.drop(dq.ERRORS)
    return RC.three_way(
        raw,
        dq.quarantined_rows(tagged),
        dq.valid_rows(tagged),
        {"null_ids": F.col("id_donante").isNull()},
    )


@query(
    "dq_table_span",
    """SELECT 'orders' AS table_name, count(*) AS row_count, CAST(min(o_orderdate) AS DATE) AS
              first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
       UNION ALL SELECT 'lineitem', count(*), CAST(min(l_shipdate) AS DATE),
              CAST(max(l_shipdate) AS DATE) FROM lineitem
       UNION ALL SELECT 'events', count(*), CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events""",
)
def _(spark, sf):
    names = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return RC.table_span({n: (B.table(spark, sf, n), c) for n, c in names.items()})


@query("dq_change_span", "SELECT min(ts) AS min_change, max(ts) AS max_change FROM events")
def _(spark, sf):
    return RC.change_span(B.table(spark, sf, "events"), "ts")


@query(
    "dq_content_differences",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN 'lost' ELSE 'changed' END AS status FROM orders
       WHERE year(o_orderdate) = 1997 AND (o_orderkey % 29 = 0 OR o_orderkey % 31 = 0)
       UNION ALL SELECT -1 - o_orderkey, 'added' FROM orders WHERE year(o_orderdate) = 1998 AND o_orderkey % 997 = 0""",
)
def _(spark, sf):
    """Two stored layers compared by content: rows that one lacks, and rows whose values differ."""
    root = scratch_path(spark, "layers")
    rows = B.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    y = F.year("o_orderdate")
    changed = F.when((y == 1997) & (F.col("o_orderkey") % 31 == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    other = rows.filter(~((y == 1997) & (F.col("o_orderkey") % 29 == 0))).withColumn("o_totalprice", changed)
    extra = rows.filter((y == 1998) & (F.col("o_orderkey") % 997 == 0)).withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    for name, df in (("a", rows), ("b", other.unionByName(extra))):
        versioned.commit(spark, f"{root}/{name}", df, {"y": y, "m": F.month("o_orderdate")})
    sides = [versioned.read_current(spark, f"{root}/{n}") for n in ("a", "b")]
    return RC.content_differences(*sides, ["o_orderkey"], ["y", "m"])[0]
