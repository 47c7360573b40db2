"""Sharding, conversation tries and clusters against brute force, and on awkward tables."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakeops.llm import interleave, orchard, ranks, trie

from . import brute

# 11 --------------------------------------------------------------------------------------


def placed(df):
    return {r["doc_id"]: (r["shard"], r["slot"]) for r in df.select("doc.doc_id", "shard", "slot").collect()}


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_interleaving_equals_brute_force(spark, shards):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 12 + ["a", "b", None, ""])) for i in range(997)]
    docs = spark.createDataFrame([(i, s, f"t{i}", 1, 2, 3) for i, s in rows], "doc_id long, source string, text string, shard int, slot int, p int")
    got = interleave.interleaved(docs.repartition(5), interleave.Rule(shards=shards))
    assert placed(got) == brute.interleaved(rows, shards)
    assert got.select("doc.*").columns == docs.columns


@pytest.mark.parametrize("lone_sources, off", [(0, 3), (200, 20)])  # small sources lie at random, which moves the cuts
def test_every_shard_has_the_mixture(spark, lone_sources, off):
    rows = [(i, "hot" if i % 3 else f"s{i % 5}") for i in range(4000)] + [(9000 + i, f"lone{i}") for i in range(lone_sources)]
    got = interleave.interleaved(spark.createDataFrame(rows, "doc_id long, source string")).select("doc.*", "shard", "slot").collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(set)
    for r in got:
        slots[r["shard"]].add(r["slot"])
    assert all(slots[s] == set(range(n)) for s, n in sizes.items())
    for source, n in Counter(s for _, s in rows).items():
        if n > 100:
            own = Counter(r["shard"] for r in got if r["source"] == source)
            assert all(abs(own[s] - n / 16) <= off for s in range(16))
    lone = Counter(r["shard"] for r in got if r["source"].startswith("lone"))
    assert max(lone.values(), default=0) < 40


def test_interleaving_of_awkward_rows(spark):
    rows = [(None, None, None)] * 40 + [(1, "a", "x")] * 40 + [(1, "a", "y"), (2, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, doc string")
    got = interleave.interleaved(docs, interleave.Rule(shards=5)).collect()
    assert Counter(tuple(r["doc"]) for r in got) == Counter(rows)
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted((n * 5 // 82, n - -(-(n * 5 // 82) * 82 // 5)) for n in range(82))
    assert interleave.interleaved(docs.limit(0)).count() == 0
    few = interleave.interleaved(docs.limit(3), interleave.Rule(shards=16)).collect()
    assert len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}


def test_interleaving_repeats_and_ignores_partitions(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    assert placed(interleave.interleaved(docs.repartition(7))) == placed(interleave.interleaved(docs.coalesce(1)))


def test_written_shards_read_back(spark, path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    want = placed(interleave.interleaved(docs, interleave.Rule(shards=3)))
    interleave.write_shards(docs, path, interleave.Rule(shards=3), rows_per_file=40)
    back = spark.read.parquet(path)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()} == want
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), (F.max("slot") - F.min("slot") + 1).alias("span")).collect()
    assert all(r["n"] <= 40 and r["n"] == r["span"] for r in files) and len(files) >= 9
    with pytest.raises(ValueError):
        interleave.write_shards(docs.withColumn("slot", F.lit(1)), path)


def test_sorted_parts_split_one_value(spark, tmp_path):
    from lakeops.llm.store import stored

    rows = stored(spark.range(2000).select(F.lit("hot").alias("g"), F.col("id").alias("row")), "rows")
    parts = ranks.sorted_parts(rows.repartition(4), ["g", "row"], "parts")
    at = parts.join(ranks.group_offsets(parts, "g"), ["g", "p"]).select("row", (F.col("before") + F.col("i") - F.col("first")).alias("rank"))
    assert at.where("row <> rank").count() == 0 and at.count() == 2000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = ranks.sorted_parts(rows, ["g", "row"], "parts")
        assert split.select("p").distinct().count() >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# 12 --------------------------------------------------------------------------------------


def nodes(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[2:]) for r in rows}
    assert len(out) == len(rows)
    return out


def conversations(seed, n=120):
    rng = random.Random(seed)
    start = [("user", "hot")] * 6 + [("user", "other"), ("system", "hot"), ("", "")]
    out = {}
    for c in range(n):
        turns = [rng.choice(start)] + [(rng.choice(["user", "bot"]), rng.choice("abc") * rng.randint(0, 3)) for _ in range(rng.randint(0, 6))]
        out[c * 3 - 30] = turns
    for c in range(500, 530):  # copies
        out[c] = list(out[0])
    out[700] = [("user", "hot")] + [("u", str(i % 7)) for i in range(90)]  # long, with a copy and near copies
    out[701] = list(out[700])
    out[702] = out[700][:60] + [("u", "else")]
    out[703] = out[700][:33]
    return out


def frame(spark, convs):
    rows = [(c, t, role or None, text or None, 1, 2, "x") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, p1 int, n int, shard string").repartition(6)


@pytest.mark.parametrize("rule", [trie.Rule(), trie.Rule(shard=16, block=8), trie.Rule(shard=1, block=1)])
def test_trie_equals_brute_force(spark, rule):
    convs = conversations(1)
    assert nodes(trie.prefix_trie(frame(spark, convs), rule)) == brute.trie(convs)


def test_spliced_trie_equals_brute_force(spark):
    import zlib

    convs = {c + 30: t for c, t in conversations(2).items()}
    del convs[300]
    convs[800] = [("u", "only")]
    want = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    assert any(not t for t in want.values())
    assert nodes(trie.spliced_trie(frame(spark, convs), trie.Rule(shard=32, block=16))) == brute.trie(want)


def test_trie_of_awkward_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert trie.spliced_trie(spark.createDataFrame([(None, 1, "u", "x")], schema)).count() == 0
    rows = [(None, 0, "u", "lost"), (5, None, "u", "first"), (5, -1, None, None), (5, 7, "u", "x" * 50_000), (6, 2, "u", "first"), (7, 1, "a", "bc"), (8, 1, "ab", "c")]
    rows += [(9, 1, "u", "same")] * 3
    convs = {5: [("u", "first"), ("", ""), ("u", "x" * 50_000)], 6: [("u", "first")], 7: [("a", "bc")], 8: [("ab", "c")], 9: [("u", "same")] * 3}
    assert nodes(trie.prefix_trie(spark.createDataFrame(rows, schema))) == brute.trie(convs)


# 13 --------------------------------------------------------------------------------------


def vectors(seed, n=400, dims=5):
    rng = random.Random(seed)
    middle = [[rng.randint(-3, 3) for _ in range(dims)] for _ in range(6)]
    return [(i, [x + rng.choice([-0.5, 0, 0, 0.25]) for x in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("k", [1, 2, 8, 40])
def test_clusters_equal_brute_force(spark, k):
    rows = vectors(k)
    scaled = [(i, [math.floor(4 * x) for x in v]) for i, v in rows]
    want, centroids = brute.clusters(scaled, k, 4)
    df = spark.createDataFrame([(i, [float(x) for x in v], 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string")
    got = orchard.clustered(df.repartition(3), orchard.Rule(clusters=k, rounds=4, dims=5, scale=4)).collect()
    assert {r["vec_id"]: (r["cluster"], r["distance"]) for r in got} == want
    by = Counter()
    for c, d in want.values():
        by[c] += d
    assert all(r["cluster_inertia"] == by[r["cluster"]] and r["inertia"] == sum(by.values()) for r in got)
    assert all(r["centroid"] == centroids[r["cluster"]] for r in got)


def test_search_measures_fewer_than_all(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    centroids = rng.integers(-1000, 1000, (60, 3))
    x = centroids[rng.integers(0, 60, 3000)] + rng.integers(-5, 6, (3000, 3))
    order, gaps = orchard.neighbour_lists(centroids)
    best, far = orchard.nearest(x, centroids, order, gaps)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    # Walks end early: from the nearest centroid only few others lie within twice the distance.
    within = (gaps[best] <= 4 * far[:, None]).sum(axis=1)
    assert within.mean() < 10


def test_unusable_vectors_are_left_out(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, inf]), (7, []), (8, [1.0, 2.0]), (8, [1.0, 2.5]), (None, [-0.3, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = orchard.clustered(df, orchard.Rule(clusters=3, rounds=2, dims=2, scale=10)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in got) == [(False, 1), (False, 8), (False, 8), (True, None)]
    assert [r["distance"] for r in got if r["vec_id"] is None] == [0]
    assert orchard.clustered(df.where("vec_id = 2"), orchard.Rule(dims=2)).count() == 0
    with pytest.raises(Exception, match="stay below"):
        orchard.clustered(spark.createDataFrame([(1, [1e30, 1.0])], df.schema), orchard.Rule(dims=2)).count()
