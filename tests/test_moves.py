"""What a change makes a table write, and what stays where it is."""

import datetime as dt

from pyspark.sql import functions as F

from lakeops.catalog.increments import _clean
from lakeops.catalog.layers import SETTINGS
from lakeops.functions.numbers import units
from lakeops.plans import bindings as B
from lakeops.plans import exports, registry
from lakeops.sinks import runs, versioned, writers
from lakeops.sources.paths import listed
from lakeops.streaming import incremental, marks

SF = "/root/testdata/sf0.001"
def _by():
    return {"y": F.col("day").substr(1, 4)}


def _rows(spark, path, rows):
    spark.createDataFrame(rows, "k long, day string, v long").write.parquet(path)
    return spark.read.parquet(path)


def _table(spark, path):
    return sorted(tuple(r) for r in versioned.read_current(spark, path).select("k", "day", "v").collect())


def test_equal_rows_leave_their_partition_alone(spark, path):
    start = [(1, "2020-01-01", 1), (2, "2020-02-01", 2), (3, "2021-01-01", 3), (None, "2022-01-01", 4)]
    first = versioned.commit(spark, path, spark.createDataFrame(start, "k long, day string, v long"), _by())
    again = [start[0], (3, "2021-01-01", 30), start[3]]
    rows = _rows(spark, f"{path}-rows", again)
    known = _rows(spark, f"{path}-known", again).select("k")
    at = versioned.replace_keys(spark, path, known, rows, ["k"], _by())
    where = versioned.manifest(spark, path).where
    assert where == {"y=2020": first, "y=2021": at, "y=2022": first}
    assert sorted(r["v"] for r in versioned.read_current(spark, path).collect()) == [1, 2, 4, 30]
    assert versioned.replace_keys(spark, path, known, rows, ["k"], _by()) == at


def test_upsert_ranks_rows_of_its_keys_only(spark, path, monkeypatch):
    start = [(k, f"202{k % 3}-01-01", 1) for k in range(60)]
    versioned.upsert(spark, path, spark.createDataFrame(start, "k long, day string, v long"), ["k"], ["v"], _by())
    ranked = []
    rank = versioned.latest_by_key
    monkeypatch.setattr(versioned, "latest_by_key", lambda df, *a: ranked.append(df.count()) or rank(df, *a))
    batch = [(3, "2021-05-01", 2), (4, "2021-01-01", 0), (99, "2020-01-01", 1)]
    versioned.upsert(spark, path, spark.createDataFrame(batch, "k long, day string, v long"), ["k"], ["v"], _by())
    assert ranked and ranked[0] <= 2 * len(batch)
    want = {k: (k, d, v) for k, d, v in start} | {3: batch[0], 99: batch[2]}
    assert _table(spark, path) == sorted(want.values())


def test_load_takes_its_mark_from_the_write(spark, path, monkeypatch):
    monkeypatch.setattr(marks, "latest_change", lambda *a: 1 / 0)
    raw = B.donations(spark, SF)
    assert incremental.load_increment(spark, raw, "donaciones", _clean, path, B.AS_OF)
    assert incremental.load_increment(spark, raw.filter("false"), "donaciones", _clean, path, B.AS_OF) is None
    newest = raw.agg(F.max("last_modified_at")).first()[0]
    assert marks.get_mark(spark, f"{path}/state", "donaciones") == newest > dt.datetime(1990, 1, 1)


def test_stored_months_are_exported_where_they_lie(spark, path, monkeypatch):
    shuffled = []
    monkeypatch.setattr(writers, "gathered", lambda df, columns: shuffled.append(df.columns) or df)
    df = spark.createDataFrame([(1, dt.date(2020, 1, 5)), (2, None)], "id_gasto long, fecha_pago date")
    spark.sql("CREATE DATABASE IF NOT EXISTS moves")
    exports.export_gold(spark, {"fact_gastos": df}, path, "moves", stored=True)
    assert not shuffled and spark.table("moves.fact_gastos").count() == 2
    exports.export_gold(spark, {"fact_gastos": df}, path, "moves")
    assert shuffled


def test_month_writes_start_from_many_parts(spark):
    df = spark.range(10).withColumns({"y": F.col("id"), "m": F.lit("01")})
    plan = writers.gathered(df, ["y", "m"])._jdf.queryExecution().executedPlan().toString()
    assert f", {writers.MONTH_CUTS})" in plan and "REBALANCE_PARTITIONS_BY_COL" in plan


def test_whole_units_are_those_of_round_without_decimals(spark):
    values = [None, float("nan"), float("inf"), 0.5, -0.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1.005, -7.125, 2.0**51 + 0.5, 2.0**63, -(2.0**63), 1e300]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for scale in (0, 2):
        got = rows.select(units(F.col("v"), scale).alias("got"), F.round(F.col("v") * F.lit(float(10**scale))).try_cast("long").alias("want"))
        assert got.filter("NOT got <=> want").isEmpty()
        assert "round(" not in rows.select(units(F.col("v"), scale))._jdf.queryExecution().analyzed().toString().lower()


def test_first_load_of_files_copies_nothing(spark, path):
    raw, name = {"gastos": B.expenses(spark, SF)}, "silver.gastos"
    registry.run_increment(spark, raw, path, [name], SETTINGS)
    assert not [p for p, _ in listed(spark, path, "scratch/*") if "-raw-" in p]
    run = runs.current(spark, path)
    newest = raw["gastos"].agg(F.max("last_modified_at")).first()[0]
    assert marks.parse_mark(run.marks["gastos"]) == newest
    assert registry.run_counts(spark, path).first()["raw"] == raw["gastos"].count()
    registry.run_increment(spark, raw, path, [name], SETTINGS)
    assert [p for p, _ in listed(spark, path, "scratch/*") if "-raw-" in p]
    rows = spark.createDataFrame(raw["gastos"].limit(5).collect(), raw["gastos"].schema)  # no files: read once
    registry.run_increment(spark, {"gastos": rows}, f"{path}-rows", [name], SETTINGS)
    assert [p for p, _ in listed(spark, f"{path}-rows", "scratch/*") if "-raw-" in p]


def test_small_batch_is_looked_up_where_the_table_lies(spark, path):
    start = [(k, f"202{k % 3}-01-01", 1) for k in range(60)]
    versioned.upsert(spark, path, spark.createDataFrame(start, "k long, day string, v long"), ["k"], ["v"], _by())
    batch = spark.createDataFrame([(3, "2021-05-01", 2), (4, "2021-01-01", 0), (99, "2024-01-01", 1)], "k long, day string, v long")
    old = versioned.read_current(spark, path)
    for few in (False, True):
        found = versioned._changes(old, batch, ["k"], ["v"], _by(), few)
        assert {r["p"] for r in found.collect()} == {"y=2020", "y=2021", "y=2024"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract") < plan.index("LeftSemi")
