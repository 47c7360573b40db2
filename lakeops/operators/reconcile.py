"""Audits across layers (DQ-17..23)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import percentage
from ..sources.paths import read_if_present
from .dedup import row_hash
from .quality import ERRORS


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def layer_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """``(table_name, layer, row_count)`` for ``{table: {layer: frame}}``."""
    return stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "row_count"
            )
            for table, by_layer in layers.items()
            for layer, df in by_layer.items()
        ]
    )


def reconcile(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Raw rows, cleaned rows, their difference and the share kept, per table.

    Each frame is counted on its own, then the few counts are pivoted; nothing is joined.
    """
    counts = layer_counts({t: {"raw": r, "silver": s} for t, (r, s) in pairs.items()})
    side = lambda name: F.sum(F.when(F.col("layer") == name, F.col("row_count")).otherwise(0))
    return (
        counts.groupBy("table_name")
        .agg(side("raw").alias("raw_rows"), side("silver").alias("silver_rows"))
        .select(
            "table_name",
            "raw_rows",
            "silver_rows",
            (F.col("raw_rows") - F.col("silver_rows")).alias("delta_rows"),
            percentage(F.col("silver_rows"), F.col("raw_rows")).alias("retention_pct"),
        )
    )


def error_counts(tagged: DataFrame) -> DataFrame:
    """Rows per error code; a row with two codes counts under both."""
    return (
        tagged.select(F.explode(ERRORS).alias("error_code"))
        .groupBy("error_code")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def quarantine_report(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """``(table_name, rule_set, run_id, error_code, row_count)`` over the stored quarantine.

    A table that never rejected a row has no folder and contributes no rows.
    """
    found = []
    for table in tables:
        rejected = read_if_present(spark, f"{root}/quarantine/{table}")
        if rejected is None:
            continue
        found.append(
            rejected.select("rule_set", "run_id", F.explode(ERRORS).alias("error_code"))
            .groupBy("rule_set", "run_id", "error_code")
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table).alias("table_name"), "*")
        )
    if not found:
        return spark.createDataFrame(
            [], "table_name string, rule_set string, run_id string, error_code string, row_count long"
        )
    return stack(found)


def three_way(
    raw: DataFrame, quarantine: DataFrame, silver: DataFrame, critical: Mapping[str, Column]
) -> DataFrame:
    """Rows of one table in raw, quarantine and silver, with NULL counts of critical columns."""
    def part(name, df):
        return df.agg(
            F.count(F.lit(1)).alias("row_count"),
            *[F.count_if(c).alias(k) for k, c in critical.items()],
        ).select(F.lit(name).alias("layer"), "row_count", *critical)

    return stack([part("raw", raw), part("quarantine", quarantine), part("silver", silver)])


def join_preservation(
    fact: DataFrame, lookup: DataFrame, keys: Sequence[str], joined: DataFrame
) -> DataFrame:
    """One row: fact rows before and after a join, and duplicate keys on the lookup side."""
    before = fact.agg(F.count(F.lit(1)).alias("n")).select(F.lit("before").alias("k"), "n")
    after = joined.agg(F.count(F.lit(1)).alias("n")).select(F.lit("after").alias("k"), "n")
    repeated = (
        lookup.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.count_if(F.col("c") > 1).alias("n"))
        .select(F.lit("repeated").alias("k"), "n")
    )
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("n")))
    return (
        stack([before, after, repeated])
        .agg(
            pick("before").alias("rows_before"),
            pick("after").alias("rows_after"),
            pick("repeated").alias("duplicate_lookup_keys"),
        )
        .withColumn("preserved", F.col("rows_before") == F.col("rows_after"))
    )


def table_span(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and first / last date per table."""
    return stack(
        [
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.min(F.to_date(date)).alias("first_date"),
                F.max(F.to_date(date)).alias("last_date"),
            ).select(F.lit(name).alias("table_name"), "row_count", "first_date", "last_date")
            for name, (df, date) in tables.items()
        ]
    )


def change_span(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_change"), F.max(column).alias("max_change"))


def preview(df: DataFrame, columns: int = 5) -> DataFrame:
    """The first few columns."""
    return df.select(*df.columns[:columns])


def sample_with_counts(df: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """A sample of rows and the non-NULL count of each of its columns (SRC-11)."""
    sample = df.limit(rows)
    counts = sample.agg(*[F.count(c).alias(c) for c in df.columns])
    return sample, counts.unpivot([], list(df.columns), "column_name", "non_null_count")


def content_sums(rows: DataFrame, by: Sequence[str], hashed: str = "h") -> DataFrame:
    """Row count and order-free sums of the row hashes in column ``hashed``, per group.

    Sums of 32-bit halves cannot overflow below 2^31 rows a group, whatever their order.
    """
    h = F.col(hashed)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftright(h, 32)).alias("high"),
    )


def _groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., n_left, n_right, differ): ``differ`` where sums are not equal or one side lacks the group."""
    side = [s.withColumn("left", F.lit(flag)) for s, flag in ((left, True), (right, False))]
    n = lambda flag: F.coalesce(F.sum(F.when(F.col("left") == flag, F.col("n"))), F.lit(0))
    parts = F.collect_set(F.struct("n", "low", "high"))  # two rows at most
    return (
        side[0].unionByName(side[1]).groupBy(*by)
        .agg(n(True).alias("n_left"), n(False).alias("n_right"), F.count(F.lit(1)).alias("sides"), F.size(parts).alias("kinds"))
        .select(*by, "n_left", "n_right", F.expr("sides < 2 OR kinds > 1").alias("differ"))
    )


def content_differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    fan_out: int = 256,
) -> tuple[DataFrame, dict[str, int]]:
    """Rows of two layers that do not agree, and what finding them cost (DQ-18, DQ-19, DQ-22).

    Compared by content, not by counts: hash sums per partition, then per bucket of keys inside the
    partitions that differ, then per key inside the buckets that differ. Partitions that agree are read once and
    never moved; further passes read differing partitions only, if ``partitions`` are those of the files.
    Result: (keys..., status), ``lost`` for keys that ``right`` lacks, ``added`` for keys that ``left`` lacks,
    ``changed`` for others, a row that moved to another partition among them. Columns that only one side
    has are not compared. Costs are rows of both sides per pass.
    """
    shared = sorted(set(left.columns) & set(right.columns))
    cells = {c for c in shared if c not in partitions}
    sides = []
    for df in (left, right):
        df = df.select(*[F.col(f"`{c}`") for c in shared])
        bucket = F.pmod(F.xxhash64(*keys), F.lit(fan_out))
        plain = [c for c in (*keys, *partitions)]
        sides.append(df.select(*dict.fromkeys(plain), bucket.alias("bucket"), row_hash(df, sorted(cells | set(partitions))).alias("h")))
    every = _groups(*[content_sums(s, partitions) for s in sides], partitions).collect()  # a row per partition
    odd = [r for r in every if r["differ"]]
    rows = lambda found: sum(r["n_left"] + r["n_right"] for r in found)
    cost = {"partitions": rows(every), "buckets": rows(odd)}
    place = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in partitions])
    names = ["/".join("\0" if r[c] is None else str(r[c]) for c in partitions) for r in odd]
    sides = [s.filter(place.isin(names)) for s in sides]
    odd = _groups(*[content_sums(s, ["bucket"]) for s in sides], ["bucket"]).filter("differ").collect()  # fan_out at most
    cost["keys"] = rows(odd)
    near = [s.filter(F.col("bucket").isin([r["bucket"] for r in odd])).withColumn("left", F.lit(flag)) for s, flag in zip(sides, (True, False))]
    n = lambda flag, value=1: F.sum(F.when(F.col("left") == flag, value).otherwise(0))
    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("h", 32)
    found = near[0].unionByName(near[1]).groupBy(*keys).agg(
        n(True).alias("n_left"), n(False).alias("n_right"), (n(True, low) - n(False, low)).alias("low"), (n(True, high) - n(False, high)).alias("high")
    )
    status = F.when(F.col("n_right") == 0, "lost").when(F.col("n_left") == 0, "added").otherwise("changed")
    found = found.filter("n_left <> n_right OR low <> 0 OR high <> 0")
    return found.select(*keys, status.alias("status")), cost
