"""Readers, writers, versioned upserts, marks and the stream."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import session
from lakeops.functions.dates import partition_columns
from lakeops.plans import silver as S
from lakeops.sinks import versioned
from lakeops.sinks import writers as W
from lakeops.sources import readers as Rd
from lakeops.sources.schemas import POLICIES, SCHEMAS, Load, Policy
from lakeops.streaming import incremental, marks

def months():
    return partition_columns(F.col("day"), day=None)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def batch(spark, *data):
    return spark.createDataFrame(
        [(k, t, dt.date.fromisoformat(d) if d else None, v) for k, t, d, v in data],
        "k int, t int, day date, v string",
    )


def test_reducers_follow_the_shuffle_size():
    assert session.reducers_for(0) == 8
    assert session.reducers_for(100 * 1024**4) == 819200


def test_scratch_uses_the_shared_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_layer_read_names_what_is_missing(spark, path):
    with pytest.raises(FileNotFoundError, match="silver.donantes"):
        Rd.read_layer(spark, path, "silver", "donantes")


def test_typed_read_and_empty_check(spark, path):
    spark.createDataFrame([], SCHEMAS["casos"]).write.parquet(path)
    df = Rd.read_typed(spark, path, "casos")
    assert df.schema.fieldNames() == SCHEMAS["casos"].fieldNames() and Rd.is_empty(df)


def test_files_with_drifting_types_in_one_folder(spark, path):
    spark.sql("SELECT 1L AS id, 2.0D AS v").coalesce(1).write.mode("append").parquet(f"{path}/y=2024")
    spark.sql("SELECT 2.0D AS id, '3' AS v, 'x' AS extra").coalesce(1).write.mode("append").parquet(f"{path}/y=2024")
    spark.sql("SELECT CAST(NULL AS DOUBLE) AS id, 'bad' AS v").coalesce(1).write.mode("append").parquet(f"{path}/y=2025")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    got = Rd.read_drifting(spark, path, target)
    assert rows(got.select("id", "v", "extra", "y"), "y", "id") == [
        (1, 2.0, None, 2024), (2, 3.0, "x", 2024), (None, None, None, 2025)
    ]


def test_extract_modes(spark):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, i)) for i in range(1, 6)], "k int, last_modified_at timestamp")
    mark, until = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)
    merge, snap = Policy("k", Load.MERGE_BY_KEY), Policy("k", Load.SNAPSHOT)
    assert Rd.extract(df, merge, mark).count() == 3
    assert Rd.extract(df, merge, mark, until).count() == 2
    assert Rd.extract(df, merge, mark, full=True).count() == 5
    assert Rd.extract(df, snap, mark, until).count() == 5
    text = df.selectExpr("k", "CASE WHEN k < 5 THEN replace(string(last_modified_at), ' ', 'T') END AS last_modified_at")
    # A row without a change time may be new at any load.
    assert Rd.extract(text, merge, mark, until).count() == 3
    assert Rd.extract(text, merge, None, until).count() == 5
    assert POLICIES["casos"].load is Load.SNAPSHOT


def test_jdbc_slices_cover_the_range_once():
    got = Rd.jdbc_slices("t", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), 2)
    assert got == [
        "t >= TIMESTAMP '2024-01-01 00:00:00.000000' AND t < TIMESTAMP '2024-01-02 00:00:00.000000'",
        "t >= TIMESTAMP '2024-01-02 00:00:00.000000' AND t <= TIMESTAMP '2024-01-03 00:00:00.000000'",
    ]


def test_dynamic_and_static_overwrite(spark, path):
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, y int")
    W.overwrite_partitions(df, path, ["y"])
    W.overwrite_partitions(spark.createDataFrame([(3, 2024)], "v int, y int"), path, ["y"])
    assert rows(spark.read.parquet(path)) == [(1, 2023), (3, 2024)]
    W.overwrite_all_partitions(spark.createDataFrame([(4, 2024)], "v int, y int"), path, ["y"])
    assert rows(spark.read.parquet(path)) == [(4, 2024)]


def test_null_dates_land_in_the_default_partition(spark, path):
    df = batch(spark, (1, 1, "2024-01-02", "a"), (2, 1, None, "b"))
    W.overwrite_all_partitions(W.with_partitions(df, "day").drop("d"), path)
    assert os.path.isdir(f"{path}/y=__HIVE_DEFAULT_PARTITION__")
    assert spark.read.parquet(path).count() == 2


def test_relayout_bound_and_missing_dates(spark):
    df = spark.createDataFrame(
        [(1, "2023-03-31T10:00:00", "2023-05-01T00:00:00Z"), (2, "2023-04-01T00:00:00", "2023-05-01T00:00:00Z"),
         (3, None, "2023-05-02"), (4, "2023-01-01", "broken")],
        "id int, fecha string, last_modified_at string",
    ).withColumn("ingest_date", F.lit("old"))
    until = dt.datetime(2023, 3, 31, 23, 59, 59)
    got = W.relayout(df, "last_modified_at", "fecha", until)
    assert rows(got.select("id", "y", "m")) == [(1, 2023, "05")]
    assert "ingest_date" not in got.columns
    no_column = W.relayout(df.drop("last_modified_at"), "last_modified_at", run_ts=until)
    assert no_column.select("y").distinct().first()[0] == 2023 and no_column.count() == 4


def test_upsert_moves_keys_and_drops_emptied_months(spark, path):
    versioned.upsert(
        spark, path,
        batch(spark, (1, 1, "2024-01-05", "a"), (2, 1, "2024-02-05", "b"), (3, 1, "2024-03-05", "c")),
        ["k"], ["t"], months(),
    )
    change = batch(spark, (1, 2, "2024-02-20", "a2"), (4, 1, None, "d"), (3, 0, "2024-03-09", "stale"))
    for _ in range(2):
        versioned.upsert(spark, path, change, ["k"], ["t"], months())
    assert rows(versioned.read_current(spark, path).select("k", "v")) == [(1, "a2"), (2, "b"), (3, "c"), (4, "d")]
    assert "y=2024/m=01" not in versioned.manifest(spark, path).where


def test_upsert_adds_columns_and_handles_no_partitions(spark, path):
    first = spark.createDataFrame([(1, 1)], "k int, t int")
    versioned.upsert(spark, path, first, ["k"], ["t"], {})
    versioned.upsert(spark, path, spark.createDataFrame([(2, 1, "x")], "k int, t int, extra string"), ["k"], ["t"], {})
    assert rows(versioned.read_current(spark, path)) == [(1, 1, None), (2, 1, "x")]


def test_a_failed_commit_leaves_the_table_alone(spark, path):
    versioned.upsert(spark, path, batch(spark, (1, 1, "2024-01-05", "a")), ["k"], ["t"], months())
    batch(spark, (9, 9, "2024-01-05", "half")).withColumns(months()).write.partitionBy("y", "m").parquet(f"{path}/data/table_version=2")
    assert rows(versioned.read_current(spark, path).select("k")) == [(1,)]
    versioned.upsert(spark, path, batch(spark, (2, 1, "2024-01-06", "b")), ["k"], ["t"], months())
    assert rows(versioned.read_current(spark, path).select("k")) == [(1,), (2,)]


def test_missing_table_is_an_error(spark, path):
    with pytest.raises(FileNotFoundError):
        versioned.read_current(spark, path)


def test_marks(spark, path):
    assert marks.get_mark(spark, path, "t") is None
    marks.set_mark(spark, path, "t", "2024-01-01T00:00:00Z", dt.datetime(2024, 1, 1))
    marks.set_all(spark, path, ["t", "u"], "2024-02-01T02:00:00+02:00", dt.datetime(2024, 1, 2))
    assert marks.get_mark(spark, path, "t") == dt.datetime(2024, 2, 1)
    marks.set_mark(spark, path, "t", dt.date(2023, 1, 1), dt.datetime(2024, 1, 3))
    assert marks.get_mark(spark, path, "t") == dt.datetime(2023, 1, 1)
    assert marks.get_mark(spark, path, "u") == dt.datetime(2024, 2, 1)
    with open(f"{path}/part-broken.parquet", "wb") as broken:
        broken.write(b"not a parquet file")
    assert marks.get_mark(spark, path, "u") == dt.datetime(2024, 2, 1)
    none = spark.createDataFrame([], "c timestamp")
    assert marks.latest_change(none, "c") is None
    for kind in ("string", "timestamp", "timestamp_ntz"):
        df = spark.sql(f"SELECT CAST(c AS {kind}) AS c FROM VALUES ('2024-01-01 10:00:00.5'), (NULL) AS t(c)")
        assert marks.latest_change(df, "c") == dt.datetime(2024, 1, 1, 10, 0, 0, 500000)


def donations(spark, *data):
    return spark.createDataFrame(
        [(i, m, dt.datetime.fromisoformat(d), dt.datetime.fromisoformat(c)) for i, m, d, c in data],
        "id_donacion long, monto double, fecha_donacion timestamp, last_modified_at timestamp",
    )


def test_incremental_load_is_idempotent(spark, path):
    source = donations(spark, (1, 10.0, "2024-01-01", "2024-01-02"), (2, -5.0, "2024-01-01", "2024-01-02"))
    load = lambda s: incremental.load_increment(spark, s, "donaciones", S.donations, path, dt.date(2024, 6, 1))
    assert load(source) == 1
    table = lambda: rows(incremental.read_valid(spark, path, "donaciones").select("id_donacion", "monto"))
    assert table() == [(1, 10.0)]
    assert spark.read.parquet(f"{path}/quarantine/donaciones").count() == 1
    more = source.union(donations(spark, (1, 11.0, "2024-03-01", "2024-03-02"), (3, 7.0, "2024-03-01", "2024-03-02")))
    load(more), load(more)
    assert table() == [(1, 11.0), (3, 7.0)]
    assert marks.get_mark(spark, f"{path}/state", "donaciones") == dt.datetime(2024, 3, 2)
    assert load(more.limit(0)) is None


def test_stream_reads_new_files_only_once(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))
    drain = lambda: incremental.stream_upserts(
        spark, spark.readStream.schema("k int, t int, day date, v string").parquet(source),
        root, checkpoint, ["k"], ["t"], months(),
    )
    batch(spark, (1, 1, "2024-01-05", "a"), (2, 1, "2024-01-05", "b")).write.parquet(source)
    drain(), drain()
    assert versioned.manifest(spark, root).number == 1
    batch(spark, (1, 2, "2024-02-05", "a2")).write.mode("append").parquet(source)
    drain()
    assert versioned.manifest(spark, root).number == 2
    assert rows(versioned.read_current(spark, root).select("k", "v")) == [(1, "a2"), (2, "b")]


def test_external_table_export_and_publish(spark, path):
    df = spark.createDataFrame([("2024-01", 1.0), ("2024-02", 2.0)], "anio_mes string, v double")
    W.write_export(df, path)
    W.register_external(spark, "exported", path)
    W.register_external(spark, "exported", path)
    assert [tuple(r) for r in spark.sql("SELECT y, m, d, v FROM exported ORDER BY m").collect()] == [(2024, 1, 1, 1.0), (2024, 2, 1, 2.0)]
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    assert W.publish_marts({"feat_x": df, "dim_x": df, "dashboard_x": df}, "marts") == ["feat_x", "dashboard_x"]
    assert spark.table("marts.feat_x").count() == 2


def test_old_versions_expire(spark, path):
    for n in range(4):
        versioned.upsert(spark, path, batch(spark, (1, n, "2024-01-05", f"a{n}"), (9, 0, "2023-01-05", "old")), ["k"], ["t"], months())
    assert versioned.manifest(spark, path).number == 4
    assert versioned.expire(spark, path, kept=1) == [2, 3]  # version 1 still holds 2023
    assert rows(versioned.read_current(spark, path).select("k", "v")) == [(1, "a3"), (9, "old")]
    assert versioned._manifests(spark, path) == [4]


def test_a_batch_without_news_commits_nothing(spark, path):
    first = batch(spark, (1, 1, "2024-01-05", "a"), (2, 1, "2024-02-05", "b"))
    assert versioned.upsert(spark, path, first, ["k"], ["t"], months()) == 1
    assert versioned.upsert(spark, path, first, ["k"], ["t"], months()) == 1
    assert versioned.upsert(spark, path, batch(spark, (2, 2, "2024-02-06", "b2")), ["k"], ["t"], months()) == 2
    assert versioned.manifest(spark, path).where == {"y=2024/m=01": 1, "y=2024/m=02": 2}


def test_month_text_keeps_two_digits(spark, path):
    versioned.upsert(spark, path, batch(spark, (1, 1, "2024-05-05", "a")), ["k"], ["t"], months())
    row = versioned.read_current(spark, path).first()
    assert (row["y"], row["m"]) == (2024, "05")


def test_a_repeated_run_replaces_its_rejects(spark, path):
    tagged = spark.createDataFrame([(1, ["X"]), (2, []), (3, ["Y"])], "id int, dq_errors array<string>")
    for run in ("a", "a", "b"):
        W.append_quarantine(tagged, path, run, "rules")
    assert spark.read.parquet(path).count() == 4
    W.append_quarantine(tagged.union(spark.createDataFrame([(4, ["X"])], tagged.schema)), path, "c", "rules", once=True)
    assert rows(spark.read.parquet(path).filter("run = 'c'").select("id")) == [(4,)]


def test_loads_of_every_policy(spark, path):
    as_of = dt.date(2024, 6, 1)
    home = spark.createDataFrame([(1, "a", 2, 1.0), (2, "b", -1, 1.0)], "id_hogar_de_paso long, nombre_hogar string, cupo_maximo int, tarifa_diaria double")
    load = lambda source, table, clean, **o: incremental.load_increment(spark, source, table, clean, path, as_of, **o)
    table = lambda name, *c: rows(incremental.read_valid(spark, path, name).select(*c))
    # A table without a change time, and a snapshot that shrinks.
    assert load(home, "hogar_de_paso", S.homes) == 1 and load(home.filter("id_hogar_de_paso = 1"), "hogar_de_paso", S.homes) == 2
    assert table("hogar_de_paso", "id_hogar_de_paso") == [(1,)]
    # A late row without a change time; a row that turns invalid and back.
    first = donations(spark, (1, 10.0, "2024-01-01", "2024-01-02"), (2, 5.0, "2024-01-01", "2024-01-03"))
    late = spark.sql("SELECT 7L AS id_donacion, 3D AS monto, TIMESTAMP'2024-01-01' AS fecha_donacion, CAST(NULL AS TIMESTAMP) AS last_modified_at")
    load(first, "donaciones", S.donations)
    load(first.union(late), "donaciones", S.donations)
    assert table("donaciones", "id_donacion", "monto") == [(1, 10.0), (2, 5.0), (7, 3.0)]
    bad = first.union(late).union(donations(spark, (1, -5.0, "2024-01-01", "2024-01-04")))
    load(bad, "donaciones", S.donations), load(bad, "donaciones", S.donations)
    assert table("donaciones", "id_donacion") == [(2,), (7,)]
    assert spark.read.parquet(f"{path}/quarantine/donaciones").count() == 1
    load(bad.union(donations(spark, (1, 6.0, "2024-01-01", "2024-01-05"))), "donaciones", S.donations)
    assert table("donaciones", "id_donacion", "monto") == [(1, 6.0), (2, 5.0), (7, 3.0)]
    # A forced reload replaces.
    load(first.filter("id_donacion = 2"), "donaciones", S.donations, full=True)
    assert table("donaciones", "id_donacion") == [(2,)]


def test_batches_read_the_months_that_may_hold_their_keys(spark, path, monkeypatch):
    """Keys that grow with time: a batch of late keys and one early correction scan two months."""
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 9) for d in (3, 17)]
    versioned.upsert(spark, path, batch(spark, *[(100 * i + j, 1, d, "a") for i, d in enumerate(days) for j in range(20)]), ["k"], ["t"], months())
    state = versioned.manifest(spark, path)
    assert state.key == "k" and state.ranges["y=2024/m=01"] == (0, 119) and len(state.ranges) == 8
    change = batch(spark, (105, 2, "2024-01-17", "b"), (1510, 2, "2024-08-17", "b"), (5000, 2, "2024-08-18", "new"), (None, 2, "2024-08-18", "null"))
    assert set(versioned.may_hold(state, change, ["k"])) == {"y=2024/m=01", "y=2024/m=08"}
    scanned = []
    monkeypatch.setattr(versioned, "_changes", lambda old, *a, f=versioned._changes: (scanned.extend(old.inputFiles()), f(old, *a))[1])
    versioned.upsert(spark, path, change, ["k"], ["t"], months())
    assert {f.split("/m=")[1][:2] for f in scanned} == {"01", "08"}
    got = {r["k"]: r["v"] for r in versioned.read_current(spark, path).filter("t = 2").collect()}
    assert got == {105: "b", 1510: "b", 5000: "new", None: "null"} and versioned.read_current(spark, path).count() == 322
    assert versioned.manifest(spark, path).ranges["y=2024/m=08"][1] == 5000
    assert versioned.may_hold(state, change.filter("k = 5000"), ["k"]) == {}
    text = change.selectExpr("CAST(k AS string) AS k", "t", "day", "v")
    assert versioned._whole_number_key(text, ["k"]) is None and versioned._whole_number_key(change, ["k", "t"]) is None


def test_stream_takes_batches_and_tells_replays(spark, path, monkeypatch):
    import shutil

    schema = "k int, t int, day date, v string"
    for n in range(4):
        batch(spark, (n, 1, "2024-01-05", f"a{n}"), (9, n, "2024-02-05", f"n{n}")).coalesce(1).write.mode("append").parquet(f"{path}/in")
    merged = []
    monkeypatch.setattr(versioned, "upsert", lambda *a, f=versioned.upsert, **o: (merged.append(o), f(*a, **o))[1])

    def drain():
        source = incremental.stream_files(spark, f"{path}/in", schema, files_per_batch=1)
        incremental.stream_upserts(spark, source, f"{path}/table", f"{path}/check", ["k"], ["t"], months())

    drain()
    assert len(merged) == 4 and versioned.manifest(spark, f"{path}/table").number == 4
    # The job died after the last table commit and before the checkpoint's.
    for name in ("3", ".3.crc"):
        target = f"{path}/check/commits/{name}"
        if os.path.exists(target):
            shutil.move(target, f"{path}/{name}.gone")
    drain()
    assert len(merged) == 4 and versioned.manifest(spark, f"{path}/table").number == 4
    got = {r["k"]: r["v"] for r in versioned.read_current(spark, f"{path}/table").collect()}
    assert got == {0: "a0", 1: "a1", 2: "a2", 3: "a3", 9: "n3"}


def test_clustered_months_skip_row_groups(spark, path):
    import glob

    import pyarrow.parquet as pq

    df = spark.range(120_000).selectExpr("id", "CAST(pmod(id * 7919, 5000) AS long) AS donor", "CAST(id % 28 AS int) AS day", "2024 + CAST(id DIV 100000000 AS int) AS y", "lpad(cast(id % 3 + 1 AS string), 2, '0') AS m")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.write_clustered(df.repartition(8), path, by=["donor", "day"], row_group_bytes=64 * 1024)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    touched = every = 0
    for file in glob.glob(f"{path}/y=*/m=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.row_group(0).column(c).path_in_schema for c in range(meta.num_columns)].index("donor")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            every += 1
            touched += stats.min <= 1234 <= stats.max
    assert touched <= 6 and every >= 12 and touched / every <= 0.25, (touched, every)
    back = spark.read.parquet(path)
    assert back.count() == 120_000 and back.filter("donor = 1234").count() == df.filter("donor = 1234").count()


def test_bucketed_facts_are_not_shuffled(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_test")
    fact = spark.range(5000).selectExpr("id", "id % 97 AS donor", "CAST(id AS double) AS amount")
    W.write_bucketed(fact, "bucket_test.fact", ["donor"], 6)
    W.write_bucketed(spark.range(100).selectExpr("id AS donor", "concat('d', id) AS name"), "bucket_test.dim", ["donor"], 6)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stats = spark.table("bucket_test.fact").groupBy("donor").agg(F.sum("amount").alias("s"))
        out = spark.table("bucket_test.fact").join(stats, "donor").join(spark.table("bucket_test.dim"), "donor")
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 5000 and out.filter("donor = 3").select("s").distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE bucket_test CASCADE")
