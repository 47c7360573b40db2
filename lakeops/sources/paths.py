"""Reading a table that may not exist yet, and removing files Spark wrote."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_if_present(
    spark: SparkSession, path: str, schema: str | None = None, **options: str
) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none. Other errors pass."""
    reader = spark.read.options(**options)
    if schema:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store Spark reaches; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def listed(spark: SparkSession, root: str, pattern: str) -> list[tuple[str, int]]:
    """(path, change time) of what matches ``pattern`` below ``root``, asked of the file system itself:
    no Spark job. For folders whose number is known to be small, such as months."""
    escaped = re.sub(r"([\[\]{}*?\\])", r"\\\1", root)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{escaped}/{pattern}")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted((f.getPath().toString(), f.getModificationTime()) for f in found or [])
