"""Mixing sources to target weights by Poisson replication (operator 4, built-in functions only).

A source's mean repetition rate is (target share x all characters) / (its characters). Each
document inverts the Poisson distribution of that mean at a number made from the MD5 of a seed and its
id, is repeated that often, and all copies are shuffled globally by another hash. Nothing depends on
the order or partitioning of the input, so a repeated run, or a repeated task, gives the same rows.

The distributions form one small row per source, joined by ``source``: broadcast where Spark knows its
stored size to be small, else shuffled with the hot source split by adaptive execution.

Edge cases: a null source is a source of its own; a source without characters keeps its rows once
(mean 1). Rows equal in ``doc_id`` repeat equally often; without an id the text's MD5 stands for it.
Columns called ``mix_copy`` or ``mix_key`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

_UNIT = 1 << 52
_SCALE = 1 << 20
_PART_CHARS = 1 << 26


@dataclass(frozen=True)
class Mix:
    """``weights`` gives sources their share of characters, relative to each other; sources it does
    not name get the square root of their characters, which lifts small ones."""

    weights: Mapping[str, float] = field(default_factory=dict)
    size: float = 1.0  # characters wanted, as a multiple of the input
    seed: int = 1


def _unit(*parts: Column) -> Column:
    """52 bits of an MD5 as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint")


def _name() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))


def rates(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, n_docs, chars, rate): the mean number of copies of a document of each source."""
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))
    # Whole-number weights: their sum does not depend on the order of addition.
    weight = F.floor(F.sqrt(F.col("chars").cast("double")) * F.lit(_SCALE))
    for source, share in mix.weights.items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.floor(F.lit(share * _SCALE))).otherwise(weight)
    sizes = stored(sizes.withColumn("weight", weight.cast("decimal(38,0)")), "sources")
    all_weight, all_chars = sizes.agg(F.sum("weight").cast("double"), F.sum("chars").cast("double")).first()
    share = F.col("weight").cast("double") / F.nullif(F.lit(all_weight or 0.0), F.lit(0.0))
    rate = share * F.lit(mix.size) * F.lit(all_chars) / F.col("chars")
    return sizes.select("source", "n_docs", "chars", F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(F.coalesce(rate, F.lit(0.0))).alias("rate"))


def _distributions(means: DataFrame) -> DataFrame:
    """(source, cdf): cdf[k] is the probability of k copies or fewer."""
    top = F.ceil(F.col("rate") + 9 * F.sqrt("rate") + 40).cast("int")
    rows = means.select("source", "rate", F.explode(F.sequence(F.lit(0), top)).alias("k"))
    order = Window.partitionBy("source").orderBy("k")
    logs = F.sum(F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.log(F.col("k").cast("double")))).over(order)
    log_p = F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.col("k") * F.log("rate")) - F.col("rate") - logs
    rows = rows.withColumn("p", F.coalesce(F.exp(log_p), F.lit(0.0)))
    rows = rows.withColumn("c", F.sum("p").over(order))
    return rows.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("cdf"))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """All copies in shuffled order, with ``mix_copy`` (1, 2, ...) and ``mix_key`` (their order)."""
    spark = docs.sparkSession
    means = rates(docs, mix)
    table = stored(_distributions(means), "distributions").select(F.col("source").alias("of"), "cdf")
    chars = means.agg(F.sum(F.col("chars") * F.col("rate"))).first()[0] or 0
    names = [c for c in docs.columns if c not in ("mix_copy", "mix_key")]
    # The row travels as one value, so no name of its own can meet one of these.
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col("source").alias("source"), _name().alias("name"))
    own = own.join(table, own["source"].eqNullSafe(table["of"]))
    at = (_unit(F.lit(mix.seed), F.col("name")).cast("double") + 0.5) / F.lit(float(_UNIT))
    own = own.select("doc", "name", "cdf", at.alias("at"))
    own = own.select("doc", "name", F.size(F.filter("cdf", lambda c: c < F.col("at"))).alias("n")).where("n > 0")
    own = own.select("doc", "name", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("mix_copy"))
    own = own.select("doc", "mix_copy", _unit(F.lit(mix.seed), F.col("name"), F.col("mix_copy").cast("string")).alias("mix_key"))
    # Keys are uniform, so equal ranges of keys are equal shares of the rows: no sample is needed to sort.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / _PART_CHARS))
    share = (F.col("mix_key").cast("double") / F.lit(float(_UNIT)) * parts).cast("int")
    dealt = own.repartitionById(parts, share).sortWithinPartitions("mix_key", "doc.doc_id", "mix_copy")
    return dealt.select(*[F.col(f"doc.`{c}`").alias(c) for c in names], "mix_copy", "mix_key")
