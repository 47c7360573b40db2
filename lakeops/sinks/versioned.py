"""Partitioned Parquet tables whose commits switch over at once (DDP-4, SNK-1, PIP-2).

Layout below the table root::

    data/table_version=<n>/<partition path>/*.parquet  files, written once, never changed
    manifest/n=<n>/*.parquet                           which version holds which partition

A commit writes the partitions it touches under a new version and then one manifest of a
single file. Readers take the newest manifest, so they never see half a table, a job that dies
half-way leaves the table as it was, and a partition whose last row moved away is simply no
longer listed. A manifest has one row per partition (a month each) and carries the table's
schema with its partition columns, so nothing is ever inferred from data files. One writer at a
time is assumed. ``expire`` removes what only old manifests refer to.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_by_key, row_hash
from ..session import scratch_path
from ..sources.paths import listed, remove
from .writers import gathered

_VERSION = "table_version"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "partition string, version int, ddl string, counts string, key string, low bigint, high bigint"
_SHARES = 1024  # parts of a batch's key range that are looked at one by one
KEPT_VERSIONS = 20
NULL_KEYS = 10_000  # keys with a NULL in them that are ever broadcast
FEW_KEYS = 3_000_000  # keys that are looked up in a broadcast, so that the table they are looked for in stays where it is
TASK_ROWS = 500_000  # rows that a task of an upsert sorts by partition and writes, whatever the size of the table


@dataclass(frozen=True)
class Manifest:
    """State of a table: its newest version, schema, and the version of each partition; ``counts``
    holds what was counted while the version was written, ``ranges`` the least and greatest ``key`` of
    partitions for which that is known."""

    number: int = 0
    ddl: str = ""
    where: dict[str, int] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    key: str | None = None
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def columns(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(self.ddl).fields} if self.ddl else {}


# Manifests never change once written, so each is read once per file.
_known: dict[tuple[str, int], Manifest] = {}
_KNOWN = 1024


def _manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests there are, at most a little over ``KEPT_VERSIONS``."""
    return sorted(_files(spark, root))


def _files(spark: SparkSession, root: str) -> dict[int, tuple[str, int]]:
    found = listed(spark, root, "manifest/n=*/*.parquet")
    return {int(re.search(r"/n=(\d+)/[^/]+$", path)[1]): (path, changed) for path, changed in found}


def _manifest(spark: SparkSession, number: int, file: tuple[str, int]) -> Manifest:
    if file not in _known:
        if len(_known) >= _KNOWN:
            _known.clear()
        rows = spark.read.schema(_MANIFEST).parquet(file[0]).collect()
        where = {r["partition"]: r["version"] for r in rows if r["partition"] is not None}
        ranges = {r["partition"]: (r["low"], r["high"]) for r in rows if r["low"] is not None}
        _known[file] = Manifest(number, rows[0]["ddl"], where, json.loads(rows[0]["counts"] or "{}"), rows[0]["key"], ranges)
    return _known[file]


def manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest:
    """The manifest of a version, by default the newest; an empty one (number 0) for a table that was
    never written."""
    if number == 0:
        return Manifest()
    files = _files(spark, root)
    if number is None:
        number = max(files, default=0)
        if not number:
            return Manifest()
    if number not in files:
        raise FileNotFoundError(f"version {number} of {root} is gone")
    return _manifest(spark, number, files[number])


def changed(old: Manifest, new: Manifest) -> set[str]:
    """Partitions whose files differ between two states of a table."""
    return {p for p in {*old.where, *new.where} if old.where.get(p) != new.where.get(p)}


def _scan(spark: SparkSession, root: str, ddl: str, where: dict[str, int]) -> DataFrame:
    if not where:
        return spark.createDataFrame([], ddl)
    paths = [f"{root}/data/table_version={v}/{p}".rstrip("/") for p, v in sorted(where.items())]
    rows = spark.read.schema(ddl).option("basePath", f"{root}/data").parquet(*paths)
    return rows.drop(_VERSION)


def exists(spark: SparkSession, root: str) -> bool:
    return bool(_manifests(spark, root))


def read(spark: SparkSession, root: str, number: int | None = None, only: Callable[[str], bool] = lambda p: True) -> DataFrame:
    """The table as of a version (the newest by default), or those of its partitions that ``only`` names."""
    state = manifest(spark, root, number)
    if not state.number:
        raise FileNotFoundError(f"no committed rows at {root}")
    return _scan(spark, root, state.ddl, {p: v for p, v in state.where.items() if only(p)})


def read_current(spark: SparkSession, root: str, below: str = "") -> DataFrame:
    """The table as of its newest commit, or its partitions whose path starts with ``below``."""
    return read(spark, root, None, lambda p: p.startswith(below))


def _path_of(columns: dict[str, Column]) -> Column:
    """Partition directory of a row, as the writer will name it."""
    return F.concat_ws(
        "/",
        *[
            F.concat(F.lit(f"{n}="), F.coalesce(c.cast("string"), F.lit(NO_VALUE)))
            for n, c in columns.items()
        ],
    )


def _partition_of_file(path: str = "_metadata.file_path") -> Column:
    return F.regexp_extract(F.col(path), r"/table_version=\d+/(?:(.*)/)?[^/]+$", 1)


def _changes(
    old: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    partitions: dict[str, Column],
    few: bool = False,
) -> DataFrame:
    """Partition names of the batch rows that are new or newer than the stored row of their key,
    and of those stored rows. Reads the key and order columns of the table only. The keys of a batch of
    ``few`` rows are looked up in a broadcast, and what is done by row is done for the stored rows of those keys."""
    if old is None:
        return batch.select(_path_of(partitions).alias("p")).distinct()
    held = old.select(*keys, F.struct(*order).alias("__old"), F.col("_metadata.file_path").alias("__file"))
    if few:
        held = held.join(F.broadcast(batch.select(*keys)), list(keys), "left_semi")
    held = held.withColumn("__at", _partition_of_file("__file")).drop("__file")
    rows = batch.select(*keys, F.struct(*order).alias("__new"), _path_of(partitions).alias("__to"))
    both = rows.join(held, list(keys), "left")
    newer = both.filter(F.col("__old").isNull() | (F.col("__new") > F.col("__old")))
    return newer.select(F.explode(F.array("__to", "__at")).alias("p")).filter("p IS NOT NULL").distinct()


def may_hold(state: Manifest, batch: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Partitions of a table that may hold a key of the batch, by the key ranges in its manifest.

    The batch's own range is cut into ``_SHARES`` parts; a partition stays out if its range meets no part
    with a key in it. Where keys grow with time, a batch then reads the keys of a few months.
    """
    if state.key is None or list(keys) != [state.key]:
        return state.where
    key = F.col(state.key).cast("bigint")
    low, high = batch.agg(F.min(key), F.max(key)).first()
    if low is None:
        return {p: v for p, v in state.where.items() if p not in state.ranges}
    width = (high - low) // _SHARES + 1
    share = F.call_function("div", key - F.lit(low), F.lit(width))
    used = {r[0] for r in batch.filter(key.isNotNull()).select(share).distinct().collect()}

    def met(p: str) -> bool:
        if p not in state.ranges:
            return True
        a, b = state.ranges[p]
        return any(i in used for i in range(max(0, (a - low) // width), min(_SHARES, (b - low) // width) + 1))

    return {p: v for p, v in state.where.items() if met(p)}


def upsert(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    partitions: dict[str, Column],
    tie_breakers: Sequence[str] | None = None,
    base: int | None = None,
    **commit_options,
) -> int:
    """Merge a batch by key and return the table's version; ``base`` and further options as in ``commit``.

    Partitions to rewrite are found by key, not only by the batch's own dates, so a row
    whose date moved to another month leaves no copy behind; partitions for which the batch has
    nothing newer stay as they are, and a batch without any newer row commits nothing. Rows are
    read in full only from the touched partitions. Applying a batch twice gives the same table
    as applying it once: a row no newer than the stored one does not replace it.

    ``partitions`` maps partition columns to expressions over the row.
    """
    names = list(partitions)
    batch = batch.drop(*names)
    state = manifest(spark, root, base)
    if not state.where:
        rows = _dealt(latest_by_key(batch, keys, order, tie_breakers), _sizes(batch, partitions), keys, partitions)
        return commit(spark, root, rows, partitions, base=base, key=_whole_number_key(batch, keys), laid_out=True, **commit_options)
    copy = scratch_path(spark, "batch")  # read twice below
    batch.write.parquet(copy)
    batch = spark.read.schema(batch.schema).parquet(copy)
    near = may_hold(state, batch, keys)
    old = _scan(spark, root, state.ddl, near) if near else None
    few = batch.count() <= FEW_KEYS
    touched = {r["p"] for r in _changes(old, batch, keys, order, partitions, few).collect()}  # months
    if not touched:
        return state.number
    affected = {p: v for p, v in state.where.items() if p in touched}
    into = batch.filter(_path_of(partitions).isin(sorted(touched)))
    commit_options |= {"key": _whole_number_key(batch, keys), "laid_out": True}
    sizes = _sizes(into, partitions)
    if not affected:
        new = _dealt(latest_by_key(into, keys, order, tie_breakers), sizes, keys, partitions)
        return commit(spark, root, new, partitions, lambda p: p in touched, base, **commit_options)
    stored = _scan(spark, root, state.ddl, affected)
    old = stored.drop(*names)
    if not few:
        sizes += _sizes(stored, {n: F.col(n) for n in names})
        new = latest_by_key(old.unionByName(into, allowMissingColumns=True), keys, order, tie_breakers)
        return commit(spark, root, _dealt(new, sizes, keys, partitions), partitions, lambda p: p in touched, base, **commit_options)
    # Only rows of the batch's keys are ranked; all others are copied where they are.
    known = into.select(*keys)
    met = of_keys(old, known, keys).unionByName(into, allowMissingColumns=True)
    kept = without_keys(old, known, keys)
    new = _dealt(latest_by_key(met, keys, order, tie_breakers), sizes, keys, partitions)
    new = kept.unionByName(new, allowMissingColumns=True)
    return commit(spark, root, new, partitions, lambda p: p in touched, base, **commit_options)


def _whole_number_key(rows: DataFrame, keys: Sequence[str]) -> str | None:
    """The key, if it is one column of whole numbers."""
    whole = len(keys) == 1 and dict(rows.dtypes)[keys[0]] in ("bigint", "int", "smallint", "tinyint")
    return keys[0] if whole else None


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def of_keys(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among the distinct keys ``known``, NULL keys included.

    Rows with a NULL in the key never go through the shuffled join, where they would meet in one task:
    their keys, few by nature, are looked up in a broadcast if there are fewer than ``NULL_KEYS``. All keys
    are if they are no more than ``FEW_KEYS``; ``known`` is counted for that and should be stored.
    """
    few = known.count() <= FEW_KEYS
    plain = rows.join(F.broadcast(known) if few else known, list(keys), "left_semi")
    odd = known.filter(_any_null(keys)).limit(NULL_KEYS + 1).collect()
    if not odd:
        return plain
    names = [f"__k_{k}" for k in keys]
    side = known.filter(_any_null(keys)).select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    side = F.broadcast(side) if len(odd) <= NULL_KEYS else side
    return plain.unionByName(rows.filter(_any_null(keys)).join(side, match, "left_semi"))


def without_keys(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other rows. For stored tables, which hold a key, also a NULL one, once."""
    names = [f"__k_{k}" for k in keys]
    side = known.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return rows.join(F.broadcast(side) if known.count() <= FEW_KEYS else side, match, "left_anti")


def replace_keys(
    spark: SparkSession,
    root: str,
    known: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    partitions: dict[str, Column],
    base: int | None = None,
    **commit_options,
) -> int:
    """Put ``rows`` in the place of all stored rows whose key is among ``known`` (distinct, stored).

    Partitions that lose or gain a row, or hold one that changed, are rewritten, wherever they are, and no
    others; without any there is no commit. Stored rows of the keys are compared with ``rows`` (stored as well,
    read twice) by a hash of their values.
    """
    state = manifest(spark, root, base)
    names = list(partitions)
    rows = rows.drop(*names)
    place = _path_of(partitions)
    if state.where and set(state.columns) == {*rows.columns, *names}:
        old = _scan(spark, root, state.ddl, state.where)
        held = of_keys(old.withColumn("__p", _partition_of_file()), known, keys)
        sides = [r.select(*keys, "__p", row_hash(r, rows.columns).alias("__h")) for r in (_in_order(held, rows), rows.withColumn("__p", place))]
        odd = sides[0].unionByName(sides[1]).groupBy(*keys, "__p", "__h").agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1")
        new = {r["__p"] for r in odd.select("__p").distinct().collect()}  # months
        if not new:
            return state.number
    else:
        new = {r["p"] for r in rows.select(place.alias("p")).distinct().collect()}  # months
        if state.where:
            held = of_keys(_scan(spark, root, state.ddl, state.where).select(*keys, _partition_of_file().alias("p")), known, keys)
            new |= {r["p"] for r in held.select("p").distinct().collect()}
    rows = rows.filter(place.isin(sorted(new)))
    touched = {p: v for p, v in state.where.items() if p in new}
    laid_out = bool(touched) and known.count() <= FEW_KEYS
    if touched:
        kept = without_keys(_scan(spark, root, state.ddl, touched), known, keys).drop(*names)
        rows = _beside(kept, rows, partitions) if laid_out else kept.unionByName(rows, allowMissingColumns=True)
    return commit(spark, root, rows, partitions, lambda p: p in new, base, laid_out=laid_out, **commit_options)


def _sizes(rows: DataFrame, partitions: dict[str, Column]) -> Counter:
    """Rows by partition path (a month each)."""
    found = rows.groupBy(_path_of(partitions).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return Counter({r["p"]: r["n"] for r in found})


def _dealt(rows: DataFrame, sizes: Mapping[str, int], keys: Sequence[str], partitions: dict[str, Column]) -> DataFrame:
    """Rows in tasks of about ``TASK_ROWS``, as ``sizes``, an upper bound by partition, has it.

    The writer sorts a task's rows by partition. A rebalance sizes tasks by compressed bytes, of which narrow rows
    have few, so such a task, and the row group it writes, grew with the table. Here small partitions share a
    task and a large one is cut by the hash of the key; sizes steer, they never drop a row.
    """
    if not partitions:
        return rows
    places, task, room = [], 0, TASK_ROWS
    for p, n in sorted(sizes.items()):
        slices = max(1, -(-n // TASK_ROWS))
        if slices > 1 or n > room:
            task, room = task + (room < TASK_ROWS), TASK_ROWS
        places.append((p, task, slices))
        task, room = (task + slices, TASK_ROWS) if slices > 1 else (task, room - n)
    tasks = max([1, *[first + slices for _, first, slices in places]])
    side = rows.sparkSession.createDataFrame(places, "__p string, __first int, __slices int")
    named = rows.withColumn("__p", _path_of(partitions)).join(F.broadcast(side), "__p", "left")
    spread = F.xxhash64(*keys)
    place = F.coalesce(F.col("__first") + F.pmod(spread, F.col("__slices")), F.pmod(spread, F.lit(tasks)))
    return named.repartitionById(tasks, place.cast("int")).drop("__p", "__first", "__slices")


def _beside(kept: DataFrame, rows: DataFrame, partitions: dict[str, Column]) -> DataFrame:
    """``kept``, which stay in the tasks that scan their partitions, and ``rows`` gathered by partition."""
    names = list(partitions)
    return kept.unionByName(gathered(rows.withColumns(partitions), names).drop(*names), allowMissingColumns=True)


def _in_order(held: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored rows with the columns of ``rows`` in their order, so that equal rows have equal hashes."""
    return held.select(*rows.columns, "__p")


def commit(
    spark: SparkSession,
    root: str,
    rows: DataFrame,
    partitions: dict[str, Column],
    replaced: Callable[[str], bool] = lambda p: True,
    base: int | None = None,
    counts: Mapping[str, Column | int] | None = None,
    pinned: Collection[int] = (),
    key: str | None = None,
    laid_out: bool = False,
) -> int:
    """Write ``rows`` as a new version and switch readers over to it.

    Partitions that ``replaced`` names (all by default) come from ``rows`` alone, and are gone if
    it has none of their rows; the others stay as they are in the version ``base`` (the newest by
    default, 0 for none). ``counts`` are aggregates over the written rows, taken by the tasks that write
    them, or numbers the caller has; they are kept in the manifest, as is the range of ``key`` in each
    partition. Versions in ``pinned`` do not expire. Rows that are ``laid_out`` come from tasks that hold few
    partitions each, such as a scan of a table with the same ones, and are written by those tasks.
    """
    state = manifest(spark, root, base)
    version = max(_manifests(spark, root), default=0) + 1
    target = f"{root}/data/table_version={version}"
    names = list(partitions)
    out = rows.withColumns(partitions) if partitions else rows
    out = out if laid_out else gathered(out, names)
    ddl = out.schema.toDDL()
    numbers = {n: c for n, c in (counts or {}).items() if isinstance(c, int)}
    numbers = {n: c for n, c in state.counts.items() if n.startswith("batch ")} | numbers  # of other streams
    aggregates = [c.alias(n) for n, c in (counts or {}).items() if n not in numbers]
    counted = Observation() if aggregates else None
    if counted:
        # After the exchange of ``gathered``, in the tasks that write: a task that is run again counts once.
        out = out.observe(counted, *aggregates)
    out.write.mode("overwrite").partitionBy(*names).parquet(target)
    present = {""}
    if names:
        folders = [path for path, _ in listed(spark, target, "/".join(f"{n}=*" for n in names))]
        present = {"/".join(path.rsplit("/", len(names))[1:]) for path in folders}  # a name per partition
    keep = {p: v for p, v in state.where.items() if not replaced(p) and p not in present}
    ranges = {p: r for p, r in state.ranges.items() if p in keep} if key == state.key else {}
    if key:
        # By file first: a file lies in one partition, so its name is taken apart once and not for each row.
        written = spark.read.schema(ddl).parquet(target).select(F.col("_metadata.file_path").alias("f"), F.col(key).cast("bigint").alias("k"))
        files = written.groupBy("f").agg(F.min("k").alias("low"), F.max("k").alias("high")).withColumn("p", _partition_of_file("f"))
        found = files.groupBy("p").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()  # months
        ranges |= {r["p"]: (r["low"], r["high"]) for r in found if r["low"] is not None}
    where = sorted({**keep, **{p: version for p in present}}.items()) or [(None, version)]
    entries = pa.table(
        {
            "partition": pa.array([p for p, _ in where], pa.string()),
            "version": pa.array([v for _, v in where], pa.int32()),
            "ddl": pa.array([ddl] * len(where), pa.string()),
            "counts": pa.array([json.dumps(numbers | (counted.get if counted else {}))] * len(where), pa.string()),
            "key": pa.array([key] * len(where), pa.string()),
            "low": pa.array([ranges.get(p, (None, None))[0] for p, _ in where], pa.int64()),
            "high": pa.array([ranges.get(p, (None, None))[1] for p, _ in where], pa.int64()),
        }
    )
    (
        spark.createDataFrame(entries)
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{root}/manifest/n={version}")
    )
    expire(spark, root, pinned=pinned)
    return version


def expire(spark: SparkSession, root: str, kept: int = KEPT_VERSIONS, pinned: Collection[int] = ()) -> list[int]:
    """Drop all but the newest and the pinned manifests, then data versions that none of the rest lists."""
    files = _files(spark, root)
    numbers = sorted(files)
    rest = [n for n in numbers if n in numbers[-kept:] or n in pinned]
    old = [n for n in numbers if n not in rest]
    if not old:
        return []
    used = {v for n in rest for v in _manifest(spark, n, files[n]).where.values()}
    for n in old:
        remove(spark, f"{root}/manifest/n={n}")
    stored = [int(path.rsplit("=", 1)[1]) for path, _ in listed(spark, root, f"data/{_VERSION}=*")]
    dropped = [v for v in sorted(stored) if v < rest[-1] and v not in used and v not in rest]
    for v in dropped:
        remove(spark, f"{root}/data/table_version={v}")
    return dropped
