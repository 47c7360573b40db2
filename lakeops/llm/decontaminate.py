"""Benchmark decontamination by winnowing (operator 1).

A window is ``Rule.words`` consecutive words of an item, or the whole of a shorter item. Of every
window of n words the least of its k-gram hashes (k = n/2, rounded up) is a fingerprint, on both
sides by the same rule, so any window that occurs in a document meets the item in at least one
fingerprint. Fingerprints are joined; each meeting is then extended word by word to both sides, up
to where a window around it could end, and counts when it spans a whole window. The hashes only
find places: the words decide.

Documents send only fingerprints that pass a fixed-size filter of the items' fingerprints. The
items' side is broadcast while its measured size is below ``BROADCAST_BYTES``; a larger one is
joined by shuffle, where adaptive execution splits a hot fingerprint.

Edge cases: null or wordless texts have no windows. Rows equal in ``doc_id`` and text get the same
result each. Items without ``item_id`` mark words but are not listed; an id with several texts is
listed once. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import membership, probably_in, stored
from .words import ALNUM, Run, grams, mix, runs

BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    words: int = 10


def _kgram(n: int) -> int:
    return (n + 1) // 2


def _fingerprints(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the fingerprints of all n-word windows inside one text."""
    k = _kgram(n)
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    g = grams(hashes, k)
    best, at = g[:m].copy(), np.arange(m)
    for j in range(1, n - k + 1):
        later = g[j : j + m]
        less = later < best
        best[less] = later[less]
        at[less] = np.flatnonzero(less) + j
    chosen = np.zeros(len(g), dtype=bool)
    chosen[at[owner[:m] == owner[n - 1 :]]] = True
    places = np.flatnonzero(chosen)
    return places, mix(g[places] + np.uint64(n))


class _Rows:
    """Fingerprint rows with the words around them, as far as a window can reach."""

    def __init__(self) -> None:
        self.row, self.length, self.hash, self.pos, self.at, self.around = [], [], [], [], [], []

    def add(self, run: Run, starts, ends, cut, n: int, places, hashes) -> None:
        k = _kgram(n)
        text = np.searchsorted(cut, places, side="right") - 1
        for t, p, h in zip(text.tolist(), places.tolist(), hashes.view(np.int64).tolist()):
            low = max(int(cut[t]), p - (n - k))
            high = min(int(cut[t + 1]), p + n)
            self.row.append(run.first + t)
            self.length.append(n)
            self.hash.append(h)
            self.pos.append(p - int(cut[t]))
            self.at.append(p - low)
            self.around.append([run.text(starts[i], ends[i]) for i in range(low, high)])

    def batch(self, lead: list[pa.Array], names: list[str]) -> pa.RecordBatch:
        rows = pa.array(self.row, pa.int64())
        return pa.RecordBatch.from_arrays(
            [c.take(rows) for c in lead]
            + [pa.array(self.length, pa.int32()), pa.array(self.hash, pa.int64()), pa.array(self.pos, pa.int32()), pa.array(self.at, pa.int32()), pa.array(self.around, pa.list_(pa.string()))],
            [*names, "length", "hash", "pos", "at", "around"],
        )


_PRINT = "length int, hash bigint, pos int, at int, around array<string>"


def item_fingerprints(items: DataFrame, rule: Rule) -> DataFrame:
    """Rows (item_id, length, hash, pos, at, around): ``around`` are words, ``at`` the k-gram's place."""

    def task(batches):
        for batch in batches:
            out = _Rows()
            for run in runs(batch.column(1)):
                starts, ends, cut = run.words(ALNUM)
                hashes = run.hashes(starts, ends)
                counts = np.diff(cut)
                owner = np.repeat(np.arange(run.texts), counts)
                for n in np.unique(np.minimum(counts[counts > 0], rule.words)).tolist():
                    places, found = _fingerprints(hashes, owner, n)
                    fits = np.minimum(counts[owner[places]], rule.words) == n
                    out.add(run, starts, ends, cut, n, places[fits], found[fits])
            yield out.batch([batch.column(0)], ["item_id"])

    return items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(task, "item_id string, " + _PRINT)


def document_fingerprints(docs: DataFrame, lengths: list[int], passes: np.ndarray) -> DataFrame:
    """A row with ``hash`` null for each input row (its n_words), and a row for each fingerprint
    that passes the filter."""

    def task(batches):
        for batch in batches:
            out = _Rows()
            n_words = np.zeros(batch.num_rows, dtype=np.int64)
            for run in runs(batch.column(2)):
                starts, ends, cut = run.words(ALNUM)
                counts = np.diff(cut)
                n_words[run.first : run.first + run.texts] = counts
                if not lengths:
                    continue
                hashes = run.hashes(starts, ends)
                owner = np.repeat(np.arange(run.texts), counts)
                for n in lengths:
                    places, found = _fingerprints(hashes, owner, n)
                    known = probably_in(passes, found)
                    out.add(run, starts, ends, cut, n, places[known], found[known])
            lead = [batch.column(0), batch.column(1), pa.array(n_words)]
            names = ["doc_id", "text_hash", "n_words"]
            none = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(lead + none, [*names, "length", "hash", "pos", "at", "around"])
            if out.row:
                yield out.batch(lead, names)

    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(task, f"doc_id {kind}, text_hash bigint, n_words bigint, " + _PRINT)


def _extend(batches):
    """Meetings -> spans of document words, where both texts agree over a whole window."""
    for batch in batches:
        length, pos, at, around, e_at, e_around = (batch.column(i).to_pylist() for i in range(3, 9))
        rows, starts, ends = [], [], []
        for i in range(batch.num_rows):
            a, b, x, y, n = around[i], e_around[i], at[i], e_at[i], length[i]
            left = 0
            while left < min(x, y) and a[x - left - 1] == b[y - left - 1]:
                left += 1
            right = 0
            while right < min(len(a) - x, len(b) - y) and a[x + right] == b[y + right]:
                right += 1
            if right >= _kgram(n) and left + right >= n:
                rows.append(i)
                starts.append(pos[i] - left)
                ends.append(pos[i] + right)
        if rows:
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["doc_id", "text_hash", "entry", "start", "end"],
            )


def overlaps(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: rows of ``docs`` (doc_id, text_hash, n_words); spans (doc_id, text_hash, entry,
    start, end) in words, end exclusive; and entries (entry, item_id)."""
    prints = stored(
        item_fingerprints(items, rule).withColumn("entry", F.md5(F.to_json(F.struct("length", "at", "around")))), "item-prints"
    )
    entries = prints.select("entry", "length", "hash", F.col("at").alias("e_at"), F.col("around").alias("e_around")).dropDuplicates(["entry", "hash"])
    lengths = sorted(r[0] for r in prints.select("length").distinct().collect())  # at most Rule.words numbers
    found = stored(document_fingerprints(docs, lengths, membership(prints, "hash")), "document-prints")
    size = entries.agg(F.sum(100 + F.octet_length(F.concat_ws(" ", "e_around")) + 32 * F.size("e_around"))).first()[0] or 0
    meetings = found.where("hash IS NOT NULL").join(F.broadcast(entries) if size <= BROADCAST_BYTES else entries, ["length", "hash"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = (
        meetings.select("doc_id", "text_hash", "entry", "length", "pos", "at", "around", "e_at", "e_around")
        .mapInArrow(_extend, f"doc_id {kind}, text_hash bigint, entry string, start int, end int")
        .distinct()
    )
    return found.where("hash IS NULL").select("doc_id", "text_hash", "n_words"), stored(spans, "spans"), prints.select("entry", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit (words inside any occurrence)
    and items (sorted ids as strings)."""
    rows, spans, entries = overlaps(docs, items, rule)
    key = ["doc_id", "text_hash"]
    order = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    own = spans.select(*key, "start", "end").distinct().withColumn("reached", F.coalesce(F.max("end").over(order), F.lit(0)))
    hits = own.groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).cast("bigint").alias("n_hit"))
    listed = spans.select(*key, "entry").distinct().join(entries, "entry").select(*key, "item_id").distinct()
    listed = listed.groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    hits = hits.join(listed, (hits["doc_id"].eqNullSafe(listed["doc_id"])) & (hits["text_hash"] == listed["text_hash"]), "left").select(
        hits["doc_id"].alias("h_id"), hits["text_hash"].alias("h_hash"), "n_hit", "items"
    )
    return rows.join(hits, rows["doc_id"].eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")), "left").select(
        *key, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` without the rows that share a window with any item."""
    _, spans, _ = overlaps(docs, items, rule)
    hit = spans.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("text_hash"))
    left = own.join(hit, F.col("doc.doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left_anti")
    return left.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
