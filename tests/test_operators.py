"""Deduplication, quality rules, joins, windows, calendar and reconciliation."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.functions.numbers import total
from lakeops.operators import aggregates as A
from lakeops.operators import calendar as Cal
from lakeops.operators import dedup, filters, joins
from lakeops.operators import quality as dq
from lakeops.operators import reconcile as RC
from lakeops.operators import windows as Wn
from lakeops.plans import rules as R


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# Deduplication


def test_latest_row_with_ties_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, "new"), (2, 3, "a"), (2, 3, "b"), (3, None, "n"), (3, 1, "y"),
         (None, 1, "p"), (None, 2, "q")],
        "k int, t int, v string",
    )
    got = dict(r[::2] for r in rows(dedup.latest_by_key(df, ["k"], ["t"], ["v"])))
    assert got == {1: "new", 2: "b", 3: "y", None: "q"}


def test_latest_row_is_the_same_for_any_input_order(spark):
    data = [(1, 5, i) for i in range(50)]
    one = dedup.latest_by_key(spark.createDataFrame(data, "k int, t int, v int"), ["k"], ["t"])
    two = dedup.latest_by_key(
        spark.createDataFrame(data[::-1], "k int, t int, v int").repartition(7), ["k"], ["t"]
    )
    assert one.first() == two.first()


def test_order_column_fallback(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, created_at int, v string")
    assert rows(dedup.latest_by_first_available(df, ["k"])) == [(1, 2, "b")]
    assert dedup.latest_by_first_available(df.drop("created_at"), ["k"]).count() == 2


# Quality


def test_rules_collect_every_broken_code(spark):
    day = lambda *a: dt.datetime(*a)
    df = spark.createDataFrame(
        [
            (1, -1.0, day(2009, 12, 31), "desconocido"),
            (2, 0.0, day(2010, 1, 1), "a@b"),
            (None, None, day(2030, 1, 1), "nope"),
            (4, 1.0, None, None),
        ],
        "id int, monto double, fecha timestamp, correo string",
    )
    rules = [
        dq.negative("NEG", "monto"),
        dq.in_future("FUT", "fecha", dt.date(2025, 1, 1)),
        dq.missing("ID", "id"),
        dq.before("OLD", "fecha", dt.date(2010, 1, 1)),
        dq.outside("OUT", "fecha", dt.date(2010, 1, 1), dt.date(2025, 1, 1)),
        dq.bad_email("MAIL", "correo", R.DONOR_EMAIL),
        dq.amount_bounds("BND", "monto", *R.AMOUNT_BOUNDS),
        dq.recent_years("REC", "fecha", 5, dt.date(2025, 1, 1)),
    ]
    tagged = dq.tag(df, rules)
    got = {r["id"]: r[dq.ERRORS] for r in tagged.collect()}
    assert got == {
        1: ["NEG", "OLD", "OUT", "BND", "REC"],
        2: ["REC"],
        None: ["FUT", "ID", "OUT", "MAIL", "REC"],
        4: [],
    }
    assert dq.valid_rows(tagged).count() + dq.quarantined_rows(tagged).count() == df.count()
    assert dq.ERRORS not in dq.valid_rows(tagged).columns


def test_table_checks(spark):
    df = spark.createDataFrame(
        [(1, 1.0, dt.date(2024, 1, 1)), (2, float("nan"), None), (None, 0.0, dt.date(2019, 1, 1))],
        "id int, monto double, fecha date",
    )
    assert dq.null_counts(df, ["id", "monto", "fecha", "gone"]) == {"id": 1, "monto": 1, "fecha": 1}
    with pytest.raises(dq.QualityError, match="x, y"):
        dq.check_columns(df, ["id", "x", "y"], "t")
    with pytest.raises(dq.QualityError, match="1 rows"):
        dq.check_years(df, "fecha")
    with pytest.raises(dq.QualityError, match="1 rows"):
        dq.check_positive(df, "monto")
    assert dq.check_years(df, "fecha", min_year=2019) is df
    assert dq.summary(df)["rows"] == 3


def test_counters_ride_along(spark, path):
    df, seen = dq.counted(spark.range(10), "n", even=F.count_if(F.col("id") % 2 == 0))
    df.write.parquet(path)
    assert seen.get == {"rows": 10, "even": 5}


# Filters


def test_month_bounds_and_slices(spark):
    assert filters.month_bounds("2023-12") == (dt.date(2023, 12, 1), dt.date(2024, 1, 1))
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 31, 23, 59),), (dt.datetime(2024, 2, 1),), (dt.datetime(2024, 2, 29, 5),),
         (dt.datetime(2024, 3, 1),), (None,)],
        "t timestamp",
    )
    assert filters.month_slice(df, "t", "2024-02").count() == 2
    assert filters.month_slice(df, "t", None).count() == 5
    parts = spark.createDataFrame([(2024, "02"), (2024, "03")], "y int, m string")
    assert rows(filters.partition_month_slice(parts, "2024-02")) == [(2024, "02")]


def test_mark_is_strict_unless_asked(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 3)], "t timestamp")
    mark = dt.datetime(2024, 1, 2)
    assert filters.after_mark(df, "t", mark).count() == 1
    assert filters.after_mark(df, "t", mark, inclusive=True).count() == 2
    assert filters.after_mark(df, "t", None).count() == 3


# Joins and windows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under key 541, some under NULL, one key without a partner."""
    return spark.range(3000).select(
        "id",
        F.expr("CASE WHEN id % 3 = 0 THEN 541 WHEN id % 50 = 1 THEN NULL ELSE id % 400 END").alias("k"),
        (F.col("id") % 7 / 4).alias("v"),
    )


@pytest.mark.parametrize("broadcast", ["-1", "20m"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, skewed, broadcast, null_safe):
    lookup = spark.range(390).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    lookup = lookup.union(spark.sql("SELECT 541L, CAST(NULL AS BIGINT) UNION ALL SELECT NULL, -1L"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plain = joins.lookup_join(skewed, lookup, ["k"], null_safe=null_safe)
        salted = joins.lookup_join(skewed, lookup, ["k"], hot="measure", null_safe=null_safe)
        assert rows(plain, "id") == rows(salted, "id")
        assert salted.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20m")


def test_unknown_hot_mode(spark, skewed):
    with pytest.raises(ValueError):
        joins.lookup_join(skewed, skewed, ["k"], hot="guess")


def test_entity_metrics_join_equals_window(spark, skewed):
    metrics = {"n": F.count("id"), "s": total(F.col("v"), 2), "hi": F.max("v")}
    joined = Wn.entity_metrics(skewed, ["k"], metrics)
    over = Window.partitionBy("k")
    window = skewed.withColumns(
        {"n": F.count("id").over(over), "s": F.sum("v").over(over), "hi": F.max("v").over(over)}
    )
    assert rows(joined, "id") == rows(window, "id")


def test_running_and_trailing_over_a_gap(spark):
    df = spark.createDataFrame([("2024-01", 1.0), ("2024-02", 2.0), ("2024-06", 4.0), ("2024-07", 8.0)], "m string, v double")
    got = df.select("m", Wn.running_total(F.col("v"), "m"), Wn.trailing_total(F.col("v"), "m"))
    assert [r[1:] for r in rows(got, "m")] == [(1.0, 1.0), (3.0, 3.0), (7.0, 7.0), (15.0, 14.0)]


def test_missing_rows_and_duplicates_on_the_right(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.missing_rows(left, right, ["k"]), "v") == [(2, "b"), (None, "c")]


# Calendar, aggregates, reconciliation


def test_calendar_span_and_attributes(spark):
    days = Cal.date_range(spark, dt.date(2020, 1, 1), dt.date(2030, 12, 31))
    assert days.count() == 4018
    row = Cal.with_calendar(days.filter("fecha = DATE '2021-01-01'")).first().asDict()
    assert (row["semana_iso"], row["anio_trimestre"], row["anio_semestre"], row["anio_mes"]) == (53, "2021-T1", "2021-S1", "2021-01")
    assert (row["nombre_dia"], row["nombre_mes"], row["es_fin_de_semana"]) == ("Friday", "January", False)


def test_monthly_rollup_golden(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 15), 100.0, 1), (2, dt.date(2024, 1, 20), 250.0, 2),
         (3, dt.date(2024, 2, 10), 500.0, 1), (4, dt.date(2024, 2, 15), 75.0, 3),
         (5, dt.date(2024, 2, 16), 0.0, 3)],
        "id int, fecha_donacion date, monto double, id_donante int",
    )
    kept = filters.positive_and_dated(df, "monto", "fecha_donacion")
    got = [tuple(r) for r in A.monthly_rollup(kept, "fecha_donacion", "monto", "id").collect()]
    assert got == [(2024, 1, 350.0, 2, 175.0), (2024, 2, 575.0, 2, 287.5)]


def test_reconcile_with_an_empty_table(spark):
    full, none = spark.range(8), spark.range(0)
    got = rows(RC.reconcile({"a": (full, spark.range(6)), "b": (none, none)}))
    assert got == [("a", 8, 6, 2, 75.0), ("b", 0, 0, 0, 0.0)]


def test_join_preservation_flags_duplicates(spark):
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    lookup = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    got = RC.join_preservation(fact, lookup, ["k"], fact.join(lookup, "k", "left")).first()
    assert tuple(got) == (2, 3, 1, False)


def test_ties_with_nulls_and_maps_have_one_survivor(spark):
    data = [(1, None, 5, {"a": 1}), (1, 5, None, {"a": 2}), (1, None, None, None)]
    ddl = "k int, a int, b int, m map<string, int>"
    seen = set()
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        df = spark.createDataFrame([data[i] for i in order], ddl).coalesce(1)
        (row,) = dedup.latest_by_key(df, ["k"], ["k"]).collect()
        seen.add((row["a"], row["b"], str(row["m"])))
    assert len(seen) == 1


def test_placeholder_join_equals_the_plain_join(spark):
    fact = spark.range(400).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 541 WHEN id % 7 = 0 THEN NULL ELSE id % 50 END AS k")
    lookup = spark.createDataFrame([(i, f"n{i}") for i in [*range(40), 541]], "k int, name string")
    plain = joins.lookup_join(fact, lookup, ["k"])
    salted = joins.lookup_join(fact, lookup, ["k"], hot=[541], salt=["id"])
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_bitmaps_count_exactly_and_merge(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), rng.choice([1, 2]), rng.choice([None, rng.randint(-70_000, 70_000), 5]), rng.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "y int, m int, a long, b int")
    bitmaps = A.distinct_bitmaps(df, ["y", "m"], ["a", "b"])
    for by in (["y", "m"], ["y"], []):
        want = df.groupBy(*by).agg(F.countDistinct("a").alias("n_a"), F.countDistinct("b").alias("n_b"))
        got = A.bitmap_counts(bitmaps, by, {"a": "n_a", "b": "n_b"})
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = A.bitmap_counts(bitmaps, ["y"], {"a": "n_a", "b": "n_b"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_content_differences_descend_only_where_needed(spark):
    rows = [(i, i // 100, f"v{i}", None if i % 7 else 1.5) for i in range(2000)] + [(None, 3, "x", None), (None, None, "y", 2.0)]
    left = spark.createDataFrame(rows, "k long, part int, v string, w double")
    assert RC.content_differences(left, left.repartition(3), ["k"], ["part"])[0].count() == 0
    other = [(k, p, v, w) for k, p, v, w in rows if k != 310]
    other = [(k, 12 if k == 555 else p, "other" if k == 321 else v, 9.0 if k == 1405 else w) for k, p, v, w in other] + [(7777, None, "z", None), (7777, None, "z", None)]
    right = spark.createDataFrame(other, "k long, part int, v string, w double").withColumn("extra", F.lit(1))
    got, cost = RC.content_differences(left, right, ["k"], ["part"], fan_out=64)
    assert {r["k"]: r["status"] for r in got.collect()} == {310: "lost", 321: "changed", 555: "changed", 1405: "changed", 7777: "added"}
    assert cost["partitions"] == len(rows) + len(other)
    assert cost["buckets"] < 1100 and cost["keys"] < 200  # five partitions of twenty; five buckets of 64
    swapped = spark.createDataFrame([(k, p, v if k != 1 else "v2", w) if k != 2 else (k, p, "v1", w) for k, p, v, w in rows], left.schema)
    assert {r["k"] for r in RC.content_differences(left, swapped, ["k"], ["part"])[0].collect()} == {1, 2}
