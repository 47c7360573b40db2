"""Session factory and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job starts from. All of them can be overridden per call.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Above 2,000 reducers map statuses only keep an average block size, which hides a hot
    # key from the adaptive skew join. Blocks 5x above the median keep their true size.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Adaptive execution merges partitions but never adds any, so it starts from many.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    # Lookups hash-join against a fact without sorting it when their partitions are small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "20m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    "spark.sql.catalogImplementation": "in-memory",
}

_REDUCER_BYTES = 128 * 1024 * 1024
_OWN_ROOTS: dict[str, str] = {}


def reducers_for(shuffle_bytes: int, floor: int = 8) -> int:
    """Initial reducer count that keeps one reduce partition near 128 MB.

    Adaptive execution only merges partitions, it never adds any, so the first number has
    to fit the largest shuffle of the job.
    """
    return max(floor, math.ceil(shuffle_bytes / _REDUCER_BYTES))


def get_spark(
    app: str = "lakeops",
    overrides: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
    master: str | None = None,
) -> SparkSession:
    """Build (or fetch) a session; ``master=None`` leaves the choice to spark-submit."""
    conf = dict(BASE_CONF)
    overrides = overrides or {}
    if shuffle_bytes is not None:
        conf["spark.sql.shuffle.partitions"] = str(reducers_for(shuffle_bytes))
    if shuffle_bytes is not None or "spark.sql.shuffle.partitions" in overrides:
        del conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    conf.update(overrides)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str, root: str | None = None) -> str:
    """Fresh, unique path below ``root``, by default the shared folder that the session's
    ``spark.checkpoint.dir`` names.

    Where that is unset, an application on one machine gets a temporary folder. On a cluster it
    has to be set, since executors would each see a disk of their own.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _OWN_ROOTS:
            _OWN_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="lakeops-")
        root = _OWN_ROOTS[context.applicationId]
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to scratch once and read from there: lineage ends, and counting them reads no column."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
