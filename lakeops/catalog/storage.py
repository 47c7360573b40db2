"""Sources and sinks: write a whole table to the shared scratch folder, read it back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import conform
from ..functions.numbers import total
from ..operators.calendar import calendar_span
from ..operators.reconcile import sample_with_counts, stack
from ..plans import bindings as B
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import readers as R
from ..sources.schemas import SCHEMAS, Load, Policy
from . import query

RUN_TS = dt.datetime(2002, 1, 1)


def _orders(spark, sf):
    return B.table(spark, sf, "orders")


@query(
    "src_partition_roundtrip",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y,
              CAST(month(o_orderdate) AS INTEGER) AS m
       FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "roundtrip")
    rows = W.with_partitions(_orders(spark, sf), "o_orderdate").drop("d")
    W.overwrite_all_partitions(rows, path)
    return R.read_table(spark, path).select("o_orderkey", "o_totalprice", "y", "m")


@query(
    "src_layer_read",
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def _(spark, sf):
    root = scratch_path(spark, "layers")
    W.write_snapshot(B.table(spark, sf, "customer"), f"{root}/silver/customer")
    return R.read_layer(spark, root, "silver", "customer").select("c_custkey", "c_name", "c_acctbal")


@query(
    "src_merge_schema",
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey < 12 THEN c_acctbal END AS c_acctbal,
              CASE WHEN c_nationkey >= 12 THEN c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def _(spark, sf):
    path = scratch_path(spark, "merge")
    customer = B.table(spark, sf, "customer")
    old, new = customer.filter("c_nationkey < 12"), customer.filter("c_nationkey >= 12")
    W.write_snapshot(old.select("c_custkey", "c_name", "c_acctbal"), f"{path}/batch=1")
    W.write_snapshot(new.select("c_custkey", "c_name", "c_mktsegment"), f"{path}/batch=2")
    return R.read_table(spark, path, merge_schema=True).drop("batch")


@query(
    "src_type_drift",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_nationkey >= 12 THEN c_name END AS c_name
       FROM customer""",
)
def _(spark, sf):
    path = scratch_path(spark, "drift")
    customer = B.table(spark, sf, "customer")
    W.write_snapshot(
        customer.filter("c_nationkey < 12").selectExpr("c_custkey", "cast(c_acctbal AS string) AS c_acctbal"),
        f"{path}/batch=1",
    )
    W.write_snapshot(
        customer.filter("c_nationkey >= 12").selectExpr(
            "cast(c_custkey AS double) AS c_custkey", "c_acctbal", "c_name"
        ),
        f"{path}/batch=2",
    )
    target = T.StructType(
        [T.StructField("c_custkey", T.LongType()), T.StructField("c_acctbal", T.DoubleType())]
    )
    return R.read_drifting(spark, path, target).drop("batch")


@query(
    "src_typed_registry",
    """SELECT o_orderkey AS id_donacion, o_custkey AS id_donante,
              CAST(o_orderdate AS DATE) AS fecha_donacion, o_totalprice AS monto,
              o_orderpriority AS medio_pago, CAST(NULL AS VARCHAR) AS comprobante
       FROM orders""",
)
def _(spark, sf):
    text = _orders(spark, sf).selectExpr(
        "cast(o_orderkey AS string) AS id_donacion",
        "cast(o_custkey AS double) AS id_donante",
        "cast(o_orderdate AS string) AS fecha_donacion",
        "cast(o_totalprice AS string) AS monto",
        "o_orderpriority AS medio_pago",
    )
    path = scratch_path(spark, "typed")
    W.write_snapshot(conform(text, SCHEMAS["donaciones"]), path)
    return R.read_typed(spark, path, "donaciones").select(
        "id_donacion",
        "id_donante",
        F.to_date("fecha_donacion").alias("fecha_donacion"),
        "monto",
        "medio_pago",
        "comprobante",
    )


@query(
    "src_calendar",
    """SELECT CAST(d AS DATE) AS fecha FROM (SELECT unnest(generate_series(
              (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
              INTERVAL 1 DAY)) AS d)""",
)
def _(spark, sf):
    return calendar_span(_orders(spark, sf), "o_orderdate")


_FEED = Policy("event_id", Load.MERGE_BY_KEY, change_column="ts")


@query(
    "src_incremental_extract",
    """SELECT event_id, user_id, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""",
)
def _(spark, sf):
    rows = R.extract(
        B.table(spark, sf, "events"), _FEED, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)
    )
    return rows.select("event_id", "user_id", "event_type", "value")


@query(
    "src_load_modes",
    """SELECT 'merge' AS mode, count(*) AS row_count FROM events
       WHERE ts >= TIMESTAMP '2024-01-15'
       UNION ALL SELECT 'snapshot', count(*) FROM events
       UNION ALL SELECT 'forced', count(*) FROM events""",
)
def _(spark, sf):
    events = B.table(spark, sf, "events")
    mark = dt.datetime(2024, 1, 15)
    snapshot = Policy("event_id", Load.SNAPSHOT, change_column="ts")
    modes = {
        "merge": R.extract(events, _FEED, mark),
        "snapshot": R.extract(events, snapshot, mark),
        "forced": R.extract(events, _FEED, mark, full=True),
    }
    return stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(m).alias("mode"), "row_count")
            for m, df in modes.items()
        ]
    )


@query(
    "src_sample_counts",
    """SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
              'o_orderpriority']) AS column_name, n AS non_null_count
       FROM (SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 50))""",
)
def _(spark, sf):
    return sample_with_counts(_orders(spark, sf), 50)[1]


# Sinks -----------------------------------------------------------------------------------


@query("snk_snapshot", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(spark, sf):
    path = scratch_path(spark, "snapshot")
    supplier = B.table(spark, sf, "supplier")
    W.write_snapshot(supplier.limit(0), path)
    W.write_snapshot(supplier, path)
    return spark.read.parquet(path).select("s_suppkey", "s_name", "s_acctbal")


@query(
    "snk_append_months",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
              count(*) AS row_count, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY 1, 2""",
)
def _(spark, sf):
    path = scratch_path(spark, "append")
    rows = W.with_partitions(_orders(spark, sf), "o_orderdate")
    W.append_partitions(rows.filter("o_orderstatus = 'F'"), path)
    W.append_partitions(rows.filter("o_orderstatus <> 'F'"), path)
    back = spark.read.parquet(path)
    return back.groupBy("y", "m").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "snk_dynamic_overwrite",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS row_count,
              CAST(sum(CASE WHEN year(o_orderdate) = 1997 THEN o_orderkey ELSE o_custkey END)
                   AS BIGINT) AS checksum
       FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderstatus = 'F' GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "dynamic")
    rows = _orders(spark, sf).select(
        "o_orderkey", "o_orderstatus", F.col("o_custkey").alias("v"), F.year("o_orderdate").alias("y")
    )
    W.overwrite_partitions(rows, path, ["y"])
    again = rows.filter("y = 1997 AND o_orderstatus = 'F'").withColumn("v", F.col("o_orderkey"))
    W.overwrite_partitions(again, path, ["y"])
    back = spark.read.parquet(path)
    return back.groupBy("y").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("v").alias("checksum")
    )


@query(
    "snk_month_export",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
              CAST(1 AS INTEGER) AS d, count(*) AS row_count
       FROM orders GROUP BY 1, 2""",
)
def _(spark, sf):
    path = scratch_path(spark, "export")
    rows = _orders(spark, sf).withColumn("anio_mes", F.date_format("o_orderdate", "yyyy-MM"))
    W.write_export(rows, path)
    return spark.read.parquet(path).groupBy("y", "m", "d").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "snk_external_table",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS m, count(*) AS row_count FROM orders
       WHERE year(o_orderdate) = 1998 GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "external")
    rows = W.with_partitions(_orders(spark, sf), "o_orderdate").drop("d")
    W.overwrite_all_partitions(rows, path)
    name = f"orders_{uuid.uuid4().hex}"
    W.register_external(spark, name, path)
    return spark.sql(f"SELECT m, count(*) AS row_count FROM {name} WHERE y = 1998 GROUP BY m")


@query(
    "snk_bronze_partitions",
    """SELECT strftime(t, '%Y') AS y, strftime(t, '%m') AS m, strftime(t, '%d') AS d,
              count(*) AS row_count
       FROM (SELECT CASE WHEN event_id % 7 < 2 THEN TIMESTAMP '2002-01-01' ELSE ts END AS t
             FROM events) GROUP BY ALL""",
)
def _(spark, sf):
    rows = B.table(spark, sf, "events").selectExpr(
        "event_id",
        """CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'no date' WHEN 2 THEN
           cast(unix_micros(ts::timestamp) AS string) ELSE cast(ts AS string) END
           AS last_modified_at""",
    )
    out = W.bronze_partitions(rows, RUN_TS)
    return out.groupBy(F.col("y").cast("string").alias("y"), "m", "d").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "snk_relayout",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
              CAST(day(l_shipdate) AS INTEGER) AS d, count(*) AS row_count
       FROM lineitem WHERE l_shipdate <= TIMESTAMP '1997-03-31 23:59:59' AND l_linenumber <> 3
       GROUP BY ALL""",
)
def _(spark, sf):
    rows = B.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_shipdate AS fecha_pago",
        "CASE WHEN l_linenumber <> 3 THEN cast(l_shipdate AS string) END AS last_modified_at",
        "'stale' AS y",
    )
    path = scratch_path(spark, "relayout")
    out = W.relayout(
        rows, "last_modified_at", "fecha_pago", dt.datetime(1997, 3, 31, 23, 59, 59), daily=True
    )
    W.overwrite_all_partitions(out, path, ["y", "m", "d"])
    return spark.read.parquet(path).groupBy("y", "m", "d").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "snk_hive_export",
    """SELECT o_orderkey AS id_donacion, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END
              AS id_donante, o_orderdate AS fecha_donacion,
              CAST(year(o_orderdate) AS INTEGER) AS anio, strftime(o_orderdate, '%m') AS mes,
              strftime(o_orderdate, '%d') AS dia
       FROM orders WHERE o_orderkey % 9 <> 0""",
)
def _(spark, sf):
    rows = _orders(spark, sf).selectExpr(
        "o_orderkey AS id_donacion",
        "CASE WHEN o_orderkey % 5 <> 0 THEN cast(o_custkey AS double) END AS id_donante",
        """CASE WHEN o_orderkey % 9 <> 0 THEN concat(cast(o_orderdate AS string), 'Z') END
           AS fecha_donacion""",
    )
    return W.hive_export(rows, "fecha_donacion")


@query(
    "snk_hive_write",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS anio, strftime(o_orderdate, '%m') AS mes,
              strftime(o_orderdate, '%d') AS dia, count(*) AS row_count,
              CAST(sum(o_custkey) AS BIGINT) AS donors FROM orders GROUP BY ALL""",
)
def _(spark, sf):
    """The daily upload as files: text partitions, read back without inference."""
    path = scratch_path(spark, "hive")
    rows = _orders(spark, sf).selectExpr(
        "o_orderkey AS id_donacion", "o_custkey AS id_donante", "o_orderdate AS fecha_donacion"
    )
    out = W.hive_export(rows, "fecha_donacion")
    W.overwrite_all_partitions(out, path, ["anio", "mes", "dia"])
    schema = f"{rows.schema.toDDL()}, anio string, mes string, dia string"
    return (
        spark.read.schema(schema)
        .parquet(path)
        .groupBy("anio", "mes", "dia")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("id_donante").alias("donors"))
    )


@query(
    "snk_write_layer",
    """SELECT 'partitioned' AS layout, count(*) AS row_count,
              count(DISTINCT (year(o_orderdate), month(o_orderdate))) AS months FROM orders
       UNION ALL SELECT 'flat', count(*), 0 FROM orders""",
)
def _(spark, sf):
    root = scratch_path(spark, "layer")
    rows = _orders(spark, sf)
    dated = rows.withColumns({"anio": F.year("o_orderdate"), "mes": F.month("o_orderdate")})
    W.write_layer(dated, f"{root}/a")
    W.write_layer(rows, f"{root}/b")
    a, b = spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b")
    count = F.count(F.lit(1)).alias("row_count")
    return a.agg(count, F.countDistinct("anio", "mes").alias("months")).select(
        F.lit("partitioned").alias("layout"), "row_count", "months"
    ).unionByName(
        b.agg(count).select(F.lit("flat").alias("layout"), "row_count", F.lit(0).cast("long").alias("months"))
    )


@query(
    "snk_publish_marts",
    "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON "
    "c_custkey = o_custkey GROUP BY c_custkey",
)
def _(spark, sf):
    counts = _orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("orders")
    )
    feature = B.table(spark, sf, "customer").select("c_custkey").join(counts, "c_custkey", "left").fillna(0)
    name = f"marts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'marts')}'")
    for _ in range(2):  # the second load replaces the first
        published = W.publish_marts({"feat_donors": feature, "dim_donors": feature}, name)
    return spark.table(f"{name}.{published[0]}")


@query(
    "snk_clustered_months",
    """SELECT o_custkey, count(*) AS orders, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1""",
)
def _(spark, sf):
    """All orders in monthly files clustered by customer and day, read back per customer."""
    path = scratch_path(spark, "clustered")
    W.write_clustered(W.with_partitions(_orders(spark, sf), "o_orderdate").drop("d"), path, by=["o_custkey", "o_orderdate"])
    rows = R.read_table(spark, path)
    return rows.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.min(F.to_date("o_orderdate")).alias("first_day"))


@query(
    "jon_bucketed",
    """SELECT c_custkey, c_mktsegment, count(o_orderkey) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(spark, sf):
    """Customers with their orders, both stored in buckets by customer: neither is shuffled by the report."""
    database = f"buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'buckets')}'")
    W.write_bucketed(_orders(spark, sf), f"{database}.orders", ["o_custkey"], 16)
    W.write_bucketed(B.table(spark, sf, "customer"), f"{database}.customer", ["c_custkey"], 16)
    stats = spark.table(f"{database}.orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("orders"), total(F.col("o_totalprice"), B.CENTS).alias("total"))
    joined = spark.table(f"{database}.customer").join(stats, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "c_mktsegment", F.coalesce("orders", F.lit(0).cast("long")).alias("orders"), "total")
