"""High-water marks, keyed upserts and the streaming load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions.casts import to_utc_naive
from ..functions.dates import partition_columns
from ..functions.numbers import total
from ..operators import filters
from ..plans import bindings as B
from ..plans import silver as S
from ..session import scratch_path
from ..sinks import versioned
from ..streaming import incremental, marks
from . import query


def _events(spark, sf):
    return B.table(spark, sf, "events")


@query(
    "inc_after_mark",
    "SELECT event_id, user_id, value FROM events WHERE ts > TIMESTAMP '2024-01-15'",
)
def _(spark, sf):
    return filters.after_mark(_events(spark, sf), "ts", dt.datetime(2024, 1, 15)).select(
        "event_id", "user_id", "value"
    )


@query(
    "inc_marks",
    """SELECT event_type AS table_name, max(ts) AS mark FROM events WHERE event_type <> 'error'
       GROUP BY 1 UNION ALL SELECT 'error', TIMESTAMP '2024-01-01 12:00:00'""",
)
def _(spark, sf):
    """Marks of all feeds in one append, then one of them reset by hand."""
    state = scratch_path(spark, "state")
    newest = _events(spark, sf).groupBy(F.col("event_type").alias("table_name")).agg(
        F.concat(F.max("ts").cast("string"), F.lit("Z")).alias("mark")
    )
    marks.set_marks(spark, state, newest, dt.datetime(2024, 2, 1))
    marks.set_mark(spark, state, "error", "2024-01-01T12:00:00Z", dt.datetime(2024, 2, 2))
    return marks.current_marks(spark, state).select(
        "table_name", to_utc_naive(F.col("mark"), TimestampType()).alias("mark")
    )


@query(
    "ddp_upsert_events",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value * 2 ELSE value END AS value,
              CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) + 40 ELSE CAST(ts AS DATE) END AS day
       FROM events""",
)
def _(spark, sf):
    """Load all events, then merge a batch that changes every third one and moves it to
    another month; the batch is merged twice."""
    root = scratch_path(spark, "upsert")
    first = _events(spark, sf).select(
        "event_id", "value", F.to_date("ts").alias("day"), F.lit(1).alias("revision")
    )
    later = first.filter("event_id % 3 = 0").select(
        "event_id",
        (F.col("value") * 2).alias("value"),
        F.date_add("day", 40).alias("day"),
        F.lit(2).alias("revision"),
    )
    months = partition_columns(F.col("day"), day=None)
    for batch in (first, later, later):
        versioned.upsert(spark, root, batch, ["event_id"], ["revision"], months)
    return versioned.read_current(spark, root).select("event_id", "value", "day")


@query(
    "inc_stream_upsert",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf):
    """Latest event per user, loaded as a stream; the second drain finds nothing new."""
    root = scratch_path(spark, "stream")
    schema = _events(spark, sf).schema
    for _ in range(2):
        source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        incremental.stream_upserts(
            spark,
            source,
            f"{root}/table",
            f"{root}/checkpoint",
            ["user_id"],
            ["ts", "event_id"],
            partition_columns(F.col("ts"), day=None),
        )
    return versioned.read_current(spark, f"{root}/table").select(
        "user_id", "event_id", "event_type", "value"
    )


@query(
    "inc_stream_bounded",
    """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders""",
)
def _(spark, sf):
    """All orders, written as eight files, streamed two files a batch; every batch commits with its number."""
    root = scratch_path(spark, "bounded")
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    orders.repartition(8, "o_orderkey").write.parquet(f"{root}/files")
    source = incremental.stream_files(spark, f"{root}/files", orders.schema, files_per_batch=2)
    incremental.stream_upserts(
        spark, source, f"{root}/table", f"{root}/checkpoint", ["o_orderkey"], ["o_orderdate"],
        {"y": F.year("o_orderdate")},
    )
    return versioned.read_current(spark, f"{root}/table").select("o_orderkey", "o_totalprice", "o_orderdate")


def _clean(df, as_of):
    return S.donations(df, as_of, first_day=dt.date(1990, 1, 1))


def _valid(spark, root, table="donaciones"):
    return incremental.read_valid(spark, root, table)


@query(
    "inc_load_cycle",
    """SELECT o_orderkey AS id_donacion, CASE WHEN o_orderstatus = 'P' AND o_orderdate >=
              TIMESTAMP '2000-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS monto
       FROM orders WHERE o_orderkey % 101 <> 0 AND NOT (o_orderstatus = 'P' AND o_orderkey % 7 = 0
         AND o_orderdate >= TIMESTAMP '2000-01-01')""",
)
def _(spark, sf):
    """First load of all donations, then an increment that corrects recent ones, some of them
    into invalid ones."""
    root = scratch_path(spark, "cycle")
    raw = B.donations(spark, sf)
    incremental.load_increment(spark, raw, "donaciones", _clean, root, B.AS_OF)
    fixed = raw.join(
        B.table(spark, sf, "orders").selectExpr("o_orderkey AS id_donacion", "o_orderstatus"),
        "id_donacion",
    ).filter("o_orderstatus = 'P' AND fecha_donacion >= TIMESTAMP_NTZ '2000-01-01'").selectExpr(
        "* EXCEPT (o_orderstatus, monto, last_modified_at)",
        "CASE WHEN monto < 0 OR id_donacion % 7 = 0 THEN -1D ELSE monto + 1 END AS monto",
        "TIMESTAMP_NTZ '2001-12-31 00:00:00' AS last_modified_at",
    )
    for _ in range(2):  # the second call starts from the moved mark and changes nothing
        incremental.load_increment(
            spark, raw.unionByName(fixed), "donaciones", _clean, root, B.AS_OF
        )
    return _valid(spark, root).select("id_donacion", "monto")


@query(
    "inc_snapshot_replace",
    """SELECT p_partkey AS id_caso, lower(p_name) AS nombre_caso FROM part WHERE p_partkey % 3 <> 0
       AND p_partkey % 70 <> 0 AND p_partkey * 7 % 1500 >= DATE '1996-01-01' - DATE '1995-06-01'""",
)
def _(spark, sf):
    """A list of cases that lost a third of its rows: they are gone from the table as well."""
    root = scratch_path(spark, "snapshot")
    clean = lambda df, as_of: S.cases(df, as_of, B.FIRST_DAY)
    for raw in (B.cases(spark, sf), B.cases(spark, sf).filter("id_caso % 3 <> 0")):
        incremental.load_increment(spark, raw, "casos", clean, root, B.AS_OF)
    return _valid(spark, root, "casos").select("id_caso", "nombre_caso")


@query(
    "inc_full_reload",
    """SELECT o_orderkey AS id_donacion, o_totalprice AS monto FROM orders
       WHERE o_orderkey % 101 <> 0 AND o_orderkey % 4 <> 0""",
)
def _(spark, sf):
    """A forced reload of a table that is otherwise merged replaces it."""
    root = scratch_path(spark, "reload")
    raw = B.donations(spark, sf)
    incremental.load_increment(spark, raw, "donaciones", _clean, root, B.AS_OF)
    incremental.load_increment(
        spark, raw.filter("id_donacion % 4 <> 0"), "donaciones", _clean, root, B.AS_OF, full=True
    )
    return _valid(spark, root).select("id_donacion", "monto")


@query(
    "inc_quarantine_repeat",
    "SELECT o_orderkey AS id_donacion, -o_totalprice AS monto FROM orders WHERE o_orderkey % 101 = 0",
)
def _(spark, sf):
    """Three loads of one source leave every rejected row once."""
    root = scratch_path(spark, "repeat")
    for _ in range(3):
        incremental.load_increment(
            spark, B.donations(spark, sf), "donaciones", _clean, root, B.AS_OF
        )
    return spark.read.parquet(f"{root}/quarantine/donaciones").select("id_donacion", "monto")


@query(
    "snk_bronze_write",
    """SELECT CAST(year(t) AS INTEGER) AS y, strftime(t, '%m') AS m, strftime(t, '%d') AS d,
              count(*) AS row_count, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS monto
       FROM (SELECT CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate ELSE TIMESTAMP '2002-01-01' END
             AS t, CASE WHEN o_orderkey % 101 = 0 THEN -o_totalprice ELSE o_totalprice END AS v
             FROM orders) GROUP BY ALL""",
)
def _(spark, sf):
    """The landing step: raw files by change day, read back with their folders' columns."""
    root = scratch_path(spark, "bronze")
    raw = B.donations(spark, sf)
    incremental.land(spark, raw, "donaciones", root, None, dt.datetime(2002, 1, 1), run_id="one")
    schema = f"{raw.schema.toDDL()}, y int, m string, d string"
    landed = spark.read.schema(schema).parquet(f"{root}/raw/donaciones/run=one")
    return landed.groupBy("y", "m", "d").agg(
        F.count(F.lit(1)).alias("row_count"), total(F.col("monto"), B.CENTS).alias("monto")
    )
