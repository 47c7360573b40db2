"""Passages that repeat, by sparse suffix arrays (operator 2).

A passage is ``Rule.words`` (50) consecutive words or more that stand at two places, in one document or in
several. Suffixes are retained where a 5-word hash is the least of 26 neighbouring ones, so every
passage holds a retained suffix with 25 words of it still ahead. Ordering by the hash of those 25
words brings candidates next to each other; a retained suffix whose neighbours differ is dropped.
Around the rest, matches are extended to both sides: the 50-word windows that such a suffix
stands for are ordered by a 64-bit hash and counted. Windows
found twice or more, joined where they touch, are the maximal repeated spans.

"Next to each other" is done by aggregation, not by one global sort: counts combine before the shuffle, so
a passage in a third of all documents is no large group anywhere, and repeats within a text are
settled where it is read. (Among n windows, n^2 / 2^65 pairs are expected to collide: none below
10^9 windows, one in 10^7 at 10^12.) Documents with the same words are one
text class, looked at once; all but the class's first document are later copies as a whole. Of a
window's places the one stays that lies in the least class (60 bits of the MD5 of its words) and
first in it.

Edge cases: null texts and texts under 50 words have no passages. Rows equal in ``doc_id`` and text
count as one document; rows without ``doc_id`` are documents too, and first in order. Other columns
are unused.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import membership, probably_in, stored
from .words import SPACED, Run, grams, mix, runs

_GRAM = 5
_MUL = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Rule:
    words: int = 50

    @property
    def ahead(self) -> int:
        return self.words // 2

    @property
    def window(self) -> int:
        return self.words - self.ahead + 1


def _span_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes, put together from powers of two."""
    levels, size = [words], 1
    while size * 2 <= n:
        a = levels[-1]
        levels.append(mix(a[:-size] * _MUL + a[size:]))
        size *= 2
    m = len(words) - n + 1
    out, at = levels[-1][:m], size
    for b in range(len(levels) - 2, -1, -1):
        if n >> b & 1:
            out = mix(out * _MUL + levels[b][at : at + m])
            at += 1 << b
    return out


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Position of the leftmost least of each n consecutive values."""
    best, at, size = values, np.arange(len(values)), 1

    def merge(best, at, shift):
        later = best[shift:] < best[:-shift]
        return np.where(later, best[shift:], best[:-shift]), np.where(later, at[shift:], at[:-shift])

    while size * 2 <= n:
        best, at = merge(best, at, size)
        size *= 2
    if size < n:
        best, at = merge(best, at, n - size)
    return at


class _Suffixes:
    """Words, retained suffixes and windows of a run of texts."""

    def __init__(self, run: Run, rule: Rule) -> None:
        starts, ends, self.cut = run.words(SPACED)
        self.hashes = run.hashes(starts, ends)
        self.counts = np.diff(self.cut)
        self.owner = np.repeat(np.arange(run.texts), self.counts)
        m = len(self.hashes) - rule.words + 1
        self.places = np.zeros(0, dtype=np.int64)
        self.whole = np.zeros(0, dtype=bool)
        if m > 0:
            self.whole = self.owner[:m] == self.owner[rule.words - 1 :]
            self.least = _least(grams(self.hashes, _GRAM), rule.window)[:m]
            chosen = np.zeros(len(self.hashes), dtype=bool)
            chosen[self.least[self.whole]] = True
            self.places = np.flatnonzero(chosen)
            self.prefixes = _span_hashes(self.hashes, rule.ahead)[self.places]
        self.run, self.starts, self.ends = run, starts, ends

    def classes(self, rule: Rule) -> list[int | None]:
        """For each text of enough words: 60 bits of the MD5 of its words joined by spaces."""
        out: list[int | None] = []
        data, cut = self.run.data, self.cut
        kept = SPACED[data]
        ends = self.ends[self.ends < len(data)]
        kept[ends] = True
        spaced = np.where(SPACED[data], data, np.uint8(32))
        for t in range(self.run.texts):
            if self.counts[t] < rule.words:
                out.append(None)
                continue
            a, b = int(self.starts[cut[t]]), int(self.ends[cut[t + 1] - 1])
            out.append(int(hashlib.md5(spaced[a:b][kept[a:b]].tobytes()).hexdigest()[:15], 16))
        return out


def _own(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return mix(values ^ mix(owner.astype(np.uint64) + np.uint64(1)))


def _source(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("string"))


def _text_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, h, n_words, c): c names the text class, null below the least length."""

    def task(batches):
        for batch in batches:
            n, c = [], []
            for run in runs(batch.column(2)):
                s = _Suffixes(run, rule)
                n += s.counts.tolist()
                c += s.classes(rule)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["doc_id", "h", "n_words", "c"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _source(docs).mapInArrow(task, f"doc_id {kind}, h bigint, n_words bigint, c bigint")


def _retained(docs: DataFrame, rule: Rule) -> DataFrame:
    """(prefix, c, inner): prefixes of retained suffixes, once per text; inner if twice in it."""

    def task(batches):
        for batch in batches:
            for run in runs(batch.column(2)):
                s = _Suffixes(run, rule)
                if len(s.places) == 0:
                    continue
                owner = s.owner[s.places]
                key = _own(s.prefixes, owner)
                _, at, n = np.unique(key, return_index=True, return_counts=True)
                names = np.array([x or 0 for x in s.classes(rule)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.prefixes[at].view(np.int64)), pa.array(names[owner[at]]), pa.array((n > 1).astype(np.int32))], ["prefix", "c", "inner"]
                )

    return _source(docs).mapInArrow(task, "prefix bigint, c bigint, inner int")


ONCE, FIRST, AGAIN = 0, 1, 2


def _windows(docs: DataFrame, rule: Rule, passes: np.ndarray) -> DataFrame:
    """(a, c, start, state): windows whose least suffix passes the filter; the state tells windows that
    stand once in the text, first of several, or again."""

    def task(batches):
        for batch in batches:
            for run in runs(batch.column(2)):
                s = _Suffixes(run, rule)
                if len(s.places) == 0:
                    continue
                good = np.zeros(len(s.hashes), dtype=bool)
                good[s.places[probably_in(passes, s.prefixes)]] = True
                at = np.flatnonzero(s.whole & good[s.least])
                if len(at) == 0:
                    continue
                a, owner = _span_hashes(s.hashes, rule.words)[at], s.owner[at]
                _, first, n = np.unique(_own(a, owner), return_index=True, return_counts=True)
                state = np.full(len(at), AGAIN, dtype=np.int32)
                state[first] = np.where(n > 1, FIRST, ONCE)
                names = np.array([x or 0 for x in s.classes(rule)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(names[owner]), pa.array((at - s.cut[owner]).astype(np.int32)), pa.array(state)],
                    ["a", "c", "start", "state"],
                )

    return _source(docs).mapInArrow(task, "a bigint, c bigint, start int, state int")


def _joined(starts: np.ndarray, words: int) -> list[tuple[int, int]]:
    """Windows at sorted starts -> maximal spans."""
    if len(starts) == 0:
        return []
    heads = np.flatnonzero(np.diff(starts, prepend=starts[0] - words - 1) > words)
    tails = np.append(heads[1:], len(starts)) - 1
    return list(zip(starts[heads].tolist(), (starts[tails] + words).tolist()))


_SPANS = "c bigint, partner bigint, spans array<struct<start:int,end:int>>, removed array<struct<start:int,end:int>>"


def _spans(found: DataFrame, rule: Rule) -> DataFrame:
    """Windows (c, code = 2 * start + later, partner) -> spans of each text class."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def task(batches):
        for batch in batches:
            every, removed = [], []
            for codes in batch.column(2):
                codes = np.sort(np.asarray(codes.as_py(), dtype=np.int64))
                starts, later = codes >> 1, codes & 1
                every.append([{"start": a, "end": b} for a, b in _joined(np.unique(starts), rule.words)])
                removed.append([{"start": a, "end": b} for a, b in _joined(starts[later == 1], rule.words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(every, kind), pa.array(removed, kind)], ["c", "partner", "spans", "removed"]
            )

    per_class = found.groupBy("c").agg(F.min("partner").alias("partner"), F.collect_set("code").alias("codes"))
    return per_class.mapInArrow(task, _SPANS)


def repeated_passages(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document with repeated passages: doc_id, text_hash, n_words, spans (start, end in
    words), removed (the parts of them whose copy elsewhere stays) and other_doc_id: the document
    where a passage stays, its own id if that is this one."""
    texts = stored(_text_rows(docs, rule), "texts").where("c IS NOT NULL").distinct()
    prefixes = (
        _retained(docs, rule)
        .groupBy("prefix")
        .agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max("inner").alias("inner"))
        .where("low <> high OR inner = 1")
    )
    passes = membership(stored(prefixes.select("prefix"), "prefixes"), "prefix")
    windows = stored(_windows(docs, rule, passes), "windows")
    own = windows.where(F.col("state") != AGAIN)
    shared = own.groupBy("a").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.max("state").alias("state")
    ).where((F.col("low") != F.col("high")) | (F.col("state") == FIRST))
    first = own.select("a", "c", "start").join(shared.select("a", "low"), "a").select(
        "c", (F.col("start") * 2 + (F.col("c") != F.col("low")).cast("int")).alias("code"), F.col("low").alias("partner")
    )
    again = windows.where(F.col("state") == AGAIN).select("c", (F.col("start") * 2 + 1).alias("code"), F.lit(None).cast("bigint").alias("partner"))
    spans = _spans(first.unionByName(again), rule)

    classes = texts.groupBy("c").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "h")).alias("first"), F.min("doc_id").alias("low_id"), F.max("doc_id").alias("high_id")
    )
    classes = classes.join(spans, "c", "left").where("copies > 1 OR spans IS NOT NULL")
    classes = stored(classes, "classes")
    named = stored(texts.groupBy("c").agg(F.min("doc_id").alias("partner_id")).withColumnRenamed("c", "partner"), "named")
    out = texts.join(classes.join(named, "partner", "left"), "c")
    all_words = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    is_first = F.struct("doc_id", "h") == F.col("first")
    copied = F.col("copies") > 1
    return out.select(
        "doc_id",
        F.col("h").alias("text_hash"),
        "n_words",
        F.when(copied, all_words).otherwise(F.col("spans")).alias("spans"),
        F.when(copied & ~is_first, all_words).otherwise(F.coalesce("removed", none)).alias("removed"),
        F.when(copied & ~F.col("doc_id").eqNullSafe(F.col("low_id")), F.col("low_id"))
        .when(copied, F.col("high_id"))
        .otherwise(F.coalesce("partner_id", "doc_id"))
        .alias("other_doc_id"),
    )
