"""One commit over all tables of a run, their marks included (INC-4, PIP-1).

Layout below the run root::

    runs/n=<k>/*.parquet   which version of each table belongs to run k, and the marks it reached

Tables commit versions of their own while a run goes on; readers do not look at those but at the
newest run, which one small file switches over. A run that dies half-way leaves every reader on
the old set, and the next run builds on that set again, not on what was left behind. One writer at a time
is assumed, as for tables.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..sources.paths import listed, remove

KEPT_RUNS = 10
_SCHEMA = "kind string, name string, value string"


@dataclass(frozen=True)
class Run:
    """A complete set: by table the version, the mark (ISO text, UTC), and the settings it was made with."""

    number: int = 0
    tables: dict[str, int] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)
    settings: dict[str, str] = field(default_factory=dict)


_known: dict[tuple[str, int], Run] = {}  # by file and time of change; the files never change


def _runs(spark: SparkSession, root: str) -> dict[int, tuple[str, int]]:
    found = listed(spark, root, "runs/n=*/*.parquet")
    return {int(re.search(r"/n=(\d+)/[^/]+$", path)[1]): (path, changed) for path, changed in found}


def _load(spark: SparkSession, number: int, file: tuple[str, int]) -> Run:
    if file not in _known:
        rows = spark.read.schema(_SCHEMA).parquet(file[0]).collect()  # a few rows per table
        of = lambda kind: {r["name"]: r["value"] for r in rows if r["kind"] == kind}
        if len(_known) >= 100 * KEPT_RUNS:
            _known.clear()
        _known[file] = Run(number, {n: int(v) for n, v in of("table").items()}, of("mark"), of("settings"))
    return _known[file]


def current(spark: SparkSession, root: str) -> Run:
    """The newest complete run; number 0 before the first."""
    found = _runs(spark, root)
    number = max(found, default=0)
    return _load(spark, number, found[number]) if number else Run()


def pinned(spark: SparkSession, root: str) -> dict[str, set[int]]:
    """Versions of each table that kept runs refer to, which must not expire."""
    out: dict[str, set[int]] = {}
    for number, file in _runs(spark, root).items():
        for table, version in _load(spark, number, file).tables.items():
            out.setdefault(table, set()).add(version)
    return out


def publish(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, int],
    marks: Mapping[str, str] | None = None,
    settings: Mapping[str, str] | None = None,
) -> int:
    """Switch readers to a new set; the last step of a run. Returns its number."""
    found = _runs(spark, root)
    number = max(found, default=0) + 1
    rows = [("table", n, str(v)) for n, v in tables.items()]
    rows += [("mark", n, v) for n, v in (marks or {}).items()] + [("settings", n, v) for n, v in (settings or {}).items()]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/runs/n={number}")
    for old in sorted(found)[: -(KEPT_RUNS - 1)]:
        remove(spark, f"{root}/runs/n={old}")
    return number
