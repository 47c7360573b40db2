"""Upserts write in tasks of a bounded number of rows, however large a month is."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeops.sinks import versioned


def _files(df):
    """Rows and months by file."""
    rows = df.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("day").alias("months"))
    return sorted((r["n"], r["months"]) for r in rows.collect())


def _by():
    return {"m": F.col("day")}


def _values(spark, path):
    return [tuple(r) for r in versioned.read_current(spark, path).select("k", "day", "v").collect()]


@pytest.mark.parametrize("few", [0, 10_000])
def test_a_large_month_is_written_by_many_tasks(spark, path, few, monkeypatch):
    monkeypatch.setattr(versioned, "TASK_ROWS", 100)
    monkeypatch.setattr(versioned, "FEW_KEYS", few)
    days = lambda k: "2024-01" if k < 2000 else f"2024-{2 + k % 3:02d}"
    first = [(k, days(k), 1) for k in range(2030)] + [(None, "2024-01", 1)]
    versioned.upsert(spark, path, spark.createDataFrame(first, "k long, day string, v long"), ["k"], ["v"], _by())
    files = _files(versioned.read_current(spark, path))
    assert len(files) == 24 and max(n for n, _ in files) < 200  # 21 of the large month, one each of the small ones
    assert set(_values(spark, path)) == set(first)

    moved = [(k, "2024-05", 2) for k in range(0, 2000, 3)]
    batch = spark.createDataFrame(moved, "k long, day string, v long")
    for _ in range(2):
        versioned.upsert(spark, path, batch, ["k"], ["v"], _by())
    files = _files(versioned.read_current(spark, path))
    assert max(n for n, _ in files) < 300
    gone = {k for k, _, _ in moved}
    found = versioned.read_current(spark, path).select("k", "day", "v").collect()
    assert len(found) == len(first) and {tuple(r) for r in found} == {r for r in first if r[0] not in gone} | set(moved)


def test_small_months_share_a_task(spark, monkeypatch):
    monkeypatch.setattr(versioned, "TASK_ROWS", 10)
    rows = spark.createDataFrame([(k, f"m{k // 4}") for k in range(20)] + [(k, "m9") for k in range(20, 45)], "k long, day string")
    sizes = versioned._sizes(rows, _by())
    assert sizes == {**{f"m=m{i}": 4 for i in range(5)}, "m=m9": 25}
    dealt = versioned._dealt(rows, sizes, ["k"], _by()).withColumn("task", F.spark_partition_id())
    by_month = {r["day"]: set(r["t"]) for r in dealt.groupBy("day").agg(F.collect_set("task").alias("t")).collect()}
    assert by_month["m0"] == by_month["m1"] and by_month["m2"] == by_month["m3"] != by_month["m0"]
    assert by_month["m9"] <= {3, 4, 5} and len(by_month["m9"]) > 1 and dealt.count() == 45


def test_rows_of_a_month_without_a_size_are_kept(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, day string")
    dealt = versioned._dealt(rows, {"m=a": 1}, ["k"], _by())
    assert dealt.columns == ["k", "day"] and sorted(r["k"] for r in dealt.collect()) == [1, 2]
