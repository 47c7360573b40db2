"""Physical plans: what must reach the scan, and how hot keys are kept apart."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from lakeops.operators import dedup, filters, joins
from lakeops.operators import windows as Wn
from lakeops.sinks.writers import gathered, with_partitions

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Small tables would all be broadcast; these tests want the plan of large ones."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20m")


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_dedup_limits_groups_before_the_shuffle(orders):
    text = plan(dedup.latest_by_key(orders, ["o_custkey"], ["o_orderdate"]))
    exchange = text.index("Exchange hashpartitioning(o_custkey")
    assert "row_number(), 1, Partial" in text[exchange:]


def test_marks_and_months_are_pushed_down(orders):
    month = plan(filters.month_slice(orders, "o_orderdate", "1998-01"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in month
    mark = plan(filters.after_mark(orders, "o_orderdate", dt.datetime(1998, 1, 1)).select("o_orderkey"))
    assert "GreaterThan(o_orderdate" in mark
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in mark


def test_hot_keys_are_salted_and_only_they_are_broadcast(shuffled, orders):
    customer = shuffled.read.parquet(f"{SF}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    text = plan(joins.lookup_join(orders, customer, ["o_custkey"], hot="measure"))
    assert "Exchange hashpartitioning(o_custkey" in text and "__salt" in text.split("Exchange hashpartitioning(o_custkey")[1][:40]
    assert text.count("BroadcastExchange") == 2  # the frequent keys, and their lookup rows
    assert f"limit={joins.HOT_ROWS}" in text


def test_writes_are_rebalanced_by_partition(orders):
    text = plan(gathered(with_partitions(orders, "o_orderdate"), ["y", "m"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "hashpartitioning(y" in text


def test_entity_metrics_aggregate_once(shuffled, orders):
    df = Wn.entity_metrics(orders, ["o_custkey"], {"n": F.count("o_orderkey"), "s": F.max("o_totalprice")})
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan parquet") == 2


@pytest.mark.parametrize(
    "name, columns",
    [
        ("bkt_tristate_budget", ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"]),
        ("ddp_latest_event_per_user", ["event_id", "ts", "user_id", "event_type", "value"]),
        ("dq_reconcile", ["l_orderkey", "l_linenumber"]),
        ("dq_join_preservation", ["o_custkey"]),
    ],
)
def test_scans_read_only_what_is_asked_for(spark, name, columns):
    from lakeops import catalog

    catalog.load()
    text = plan(catalog.QUERIES[name](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    widest = max((s.split(",") for s in schemas), key=len)
    assert {c.split(":")[0] for c in widest} <= {"", *columns, "p_partkey", "p_size", "p_retailprice", "c_custkey"}


def test_two_lookups_need_three_scans(spark):
    from lakeops import catalog

    catalog.load()
    assert plan(catalog.QUERIES["jon_two_dims"](spark, SF)).count("FileScan parquet") == 3


def test_placeholder_keys_are_salted_without_counting(shuffled, orders):
    customer = shuffled.read.parquet(f"{SF}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    text = plan(joins.lookup_join(orders, customer, ["o_custkey"], hot=[541], salt=["o_orderkey"]).select("o_orderkey", "c_name"))
    assert text.count("BroadcastExchange") == 1 and "HashAggregate" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
