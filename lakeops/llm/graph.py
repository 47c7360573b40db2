"""Connected components over an edge table, all inside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    # Sums of 32-bit halves cannot overflow a long and do not depend on row order.
    h = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(h, 32))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (u, v): root is its component's least node.

    Alternating large-star and small-star steps; each is a combined aggregate, stored, plus a join to it,
    which the adaptive skew join can split since both sides are plain shuffles. No edges: no rows.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        state = _state(now)
        if state == before or state[0] == 0:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = stored(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
