"""Incremental loads into keyed tables, as a batch and as a stream (INC-3, INC-7, D1)."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import AsOf, partition_columns
from ..operators import quality as dq
from ..sinks import versioned
from ..sinks.writers import append_quarantine, bronze_partitions, overwrite_all_partitions
from ..sources.paths import read_if_present
from ..sources.readers import extract
from ..sources.schemas import POLICIES, Load
from . import marks

_VALID, _REJECTED = "rejected=false", "rejected=true"


def land(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    root: str,
    since: dt.datetime | None,
    run_ts: dt.datetime,
    full: bool = False,
    run_id: str = "",
) -> DataFrame | None:
    """What ``landed`` returns, without the change time."""
    return landed(spark, source, table, root, since, run_ts, full, run_id)[0]


def landed(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    root: str,
    since: dt.datetime | None,
    run_ts: dt.datetime,
    full: bool = False,
    run_id: str = "",
) -> tuple[DataFrame | None, dt.datetime | None]:
    """Extract what changed since the mark, once, and store it as raw files of this run.

    The rows land below ``raw/<table>/run=<id>`` by change day; everything later reads them, not the
    source. None if there are none. The newest change time comes with them, as found by the tasks that write.
    A repeated run replaces its own folder.
    """
    policy = POLICIES[table]
    rows = extract(source, policy, since, full=full)
    path = f"{root}/raw/{table}/run={run_id}"
    counts = {"rows": F.count(F.lit(1))}
    if policy.change_column:
        counts["newest"] = marks.newest_change(rows, policy.change_column)
    out = bronze_partitions(rows, run_ts, policy.change_column or "")
    found = overwrite_all_partitions(out, path, ["y", "m", "d"], counts=counts)
    if not found["rows"]:
        return None, None
    return read_if_present(spark, path, rows.schema.toDDL()), marks.from_micros(found.get("newest"))


def load_increment(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    clean: Callable[[DataFrame, AsOf], DataFrame],
    root: str,
    as_of: AsOf = None,
    full: bool = False,
    run_id: str | None = None,
    run_ts: dt.datetime | None = None,
) -> int | None:
    """Land what changed since the mark, clean it, store it by key, then move the mark.

    Returns the table's version, or None when nothing arrived. Snapshot tables, tables
    without a change time and forced reloads (``full``) replace the stored table, so rows that
    are gone from the source are gone here. Other tables are merged by key. Rows are stored with
    the outcome of their rules and ranked together, so a row that is corrected into an invalid
    one leaves the valid rows (``read_valid``), and comes back when it is corrected again. Rows
    without a change time are read by every load, as no mark can tell whether they are new.

    The new mark is the newest change time among the landed rows. It is stored last; a load
    that fails before is repeated, and repeating a load changes nothing: not the table, and not
    the quarantine, which holds a rejected row once whatever the number of loads that read it.
    """
    policy = POLICIES[table]
    state, path = f"{root}/state", f"{root}/silver/{table}"
    run_id = run_id or uuid.uuid4().hex
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    snapshot = full or policy.load is Load.SNAPSHOT or policy.change_column is None
    since = None if snapshot else marks.get_mark(spark, state, table)
    rows, until = landed(spark, source, table, root, since, run_ts, full, run_id)
    if rows is None:
        return None
    cleaned = clean(rows, as_of)
    tagged = dq.ERRORS in cleaned.columns
    flag = (F.size(dq.ERRORS) > 0) if tagged else F.lit(False)
    partitions = {"rejected": flag.cast("string")}
    if policy.business_date:
        partitions |= partition_columns(F.col(policy.business_date), day=None)
    if snapshot:
        version = versioned.commit(spark, path, cleaned, partitions)
    else:
        version = versioned.upsert(spark, path, cleaned, [policy.key], [policy.change_column], partitions)
    if tagged:
        now = versioned.read_current(spark, path, _REJECTED).drop(*partitions)
        append_quarantine(now, f"{root}/quarantine/{table}", run_id, table, once=True)
    if until is not None and (since is None or until > since):
        marks.set_mark(spark, state, table, until)
    return version


def read_valid(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The valid rows of a loaded table."""
    rows = versioned.read_current(spark, f"{root}/silver/{table}", _VALID)
    return rows.drop(dq.ERRORS, "rejected")


def stream_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1000, **options: str) -> DataFrame:
    """A folder of Parquet files as a stream whose batches, the first one too, take so many files at most."""
    return spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, which a checkpoint keeps for good."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_upserts(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    partitions: dict[str, Column],
    tie_breakers: Sequence[str] | None = None,
) -> None:
    """Drain a streaming source into a keyed table and stop.

    The checkpoint remembers which files were read, so the next call only sees new ones; the source says how
    many files make a batch (``stream_files``). A batch's number is committed with its rows. One that is
    replayed, because the job died between that commit and the checkpoint's, is told by its number and not
    merged again; a batch that died before is merged like a new one.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        mark = f"batch {_stream_id(session, checkpoint)}"
        if versioned.manifest(session, root).counts.get(mark, -1) >= batch_id or batch.isEmpty():
            return
        versioned.upsert(session, root, batch, keys, order, partitions, tie_breakers, counts={mark: batch_id})

    (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
