"""Stored intermediate tables and fixed-size membership filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

FILTER_BITS = 1 << 25


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here, and a lost
    executor costs tasks, not the job."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def membership(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit set of the 64-bit hashes in ``column`` (one hash function).

    Its size is fixed (4 MiB), so it may go to the driver and to every task at any input size. A
    full filter passes everything: it only ever spares later work, never decides.
    """
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        df.select(F.shiftright(slot, 6).cast("int").alias("w"), slot.bitwiseAND(F.lit(63)).cast("int").alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("b"))).alias("v"))
        .toPandas()
    )
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words["w"].to_numpy(dtype=np.int64)] = words["v"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def probably_in(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Boolean mask; never False for a member."""
    slot = hashes.view(np.uint64) & np.uint64(len(filter_words) * 64 - 1)
    return (filter_words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
