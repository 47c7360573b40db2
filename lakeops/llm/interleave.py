"""Sharding by proportional stratified interleaving (operator 11, built-in functions only).

The rows of each source are put into a seeded random order and ranked. A row's fractional rank is
(rank + phase) / size of its source, the phase being a seeded number per source, so that small sources do
not all meet in the middle. Sorted by fractional rank, every stretch of fractional ranks holds each source in
its share, to within a row; the sorted table is cut into shards whose counts differ by one at most. Within a shard rows keep that order, so every prefix of a shard has the mixture too.

Both rankings sort narrow rows over all tasks by keys that end with a row number, and get exact ranks from
counts per range (``ranks``): a source that holds most rows is spread over many tasks. Whole rows move
once, when they are joined to their place by row number.

Edge cases: a null source is a source of its own. Order within a source is by the MD5 of seed and
``doc_id`` (null: empty), then ``doc_id``, then a hash of the row; rows equal in all columns are
interchangeable, but each gets a place. Fewer rows than shards: some shards stay empty. No rows: no rows.
Columns keep their names inside ``doc``, so none can clash. Needs ``doc_id`` and ``source`` only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import fraction, group_offsets, sorted_parts, total_offsets, unit
from .store import stored


@dataclass(frozen=True)
class Rule:
    shards: int = 16
    seed: int = 1


def interleaved(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows (doc, shard, slot): ``doc`` holds the row as it was, ``slot`` its place in the shard, from 0."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("source").cast("string").alias("source"),
        unit(F.lit(rule.seed), doc_id).alias("h"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    own = stored(own, "rows")
    keys = own.select("source", "h", F.col("doc.doc_id").alias("doc_id"), "tie", "row")
    shuffled = sorted_parts(keys, ["source", "h", "doc_id", "tie", "row"], "shuffled").select("source", "row", "p", "i")
    pieces = group_offsets(shuffled, "source")
    pieces = pieces.select(*[F.col(c).alias(f"s_{c}") for c in pieces.columns])
    same = (F.col("p") == F.col("s_p")) & F.col("source").eqNullSafe(F.col("s_source"))
    rank = F.col("s_before") + F.col("i") - F.col("s_first")
    phase = fraction(F.lit(rule.seed), F.coalesce(F.col("s_source"), F.lit("")))
    ranked = shuffled.join(pieces.withColumn("phase", phase), same).select(
        "row", "source", rank.alias("rank"), ((rank + F.col("phase")) / F.col("s_size")).alias("share")
    )
    ranked = stored(ranked, "ranked")
    mixed = sorted_parts(ranked, ["share", "source", "rank", "row"], "mixed").select("row", "p", "i")
    at, shards = total_offsets(mixed), F.lit(rule.shards).cast("bigint")
    placed = mixed.join(at, "p").withColumn("n", F.col("before") + F.col("i"))
    placed = placed.withColumn("shard", F.call_function("div", F.col("n") * shards, F.col("size")))
    start = F.call_function("div", F.col("shard") * F.col("size") + shards - 1, shards)
    placed = placed.select("row", F.col("shard").cast("int").alias("shard"), (F.col("n") - start).alias("slot"))
    return own.select("row", "doc").join(placed, "row").select("doc", "shard", "slot")


def write_shards(docs: DataFrame, path: str, rule: Rule = Rule(), rows_per_file: int = 1_000_000) -> None:
    """Parquet folders ``shard=0``, ``shard=1``, ... with the columns of ``docs`` and ``slot``, in that order:
    file after file, each of at most ``rows_per_file`` rows, so that a large shard is no single task's work.
    ``docs`` must not have columns of these two names itself."""
    names = {"shard", "slot"} & set(docs.columns)
    if names:
        raise ValueError(f"columns {sorted(names)} are in use")
    rows = interleaved(docs, rule).select("doc.*", "shard", "slot")
    piece = F.call_function("div", F.col("slot"), F.lit(rows_per_file).cast("bigint"))
    rows = rows.repartition("shard", piece).sortWithinPartitions("shard", "slot")
    rows.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
