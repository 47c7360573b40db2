"""Repeated runs of lines by distributed prefix doubling (operator 7, built-in functions only).

The lines with a word form each document's sequence of line ids. As in the construction of a suffix
array by prefix doubling, runs of 2^t lines get their name from the names of their two halves, and a
name's first place (by doc_id, then place) stands for its interval of equal prefixes. Only runs
that occur twice stay in play, so rounds shrink quickly. A run of any length L with 2^t < L < 2^(t+1)
is named by L and the names of its first and its last 2^t lines, which overlap.

A run of any number of lines that has ``Rule.words`` words or more and occurs earlier is a later copy;
all lines in such runs are deleted. Two runs a line are enough to find them all: the shortest with
``Rule.words`` words that starts with it, and the shortest that ends with it. Parts of a later copy occur
earlier too; of a line in a later copy, either the words from the copy's start up to the line suffice, and
the shortest run that ends with the line lies in the copy, or they do not, and the shortest run from the
copy's start goes past the line. Which run is shortest follows from its lines, so copies agree on it. It has
``Rule.words`` lines at most, so log2(words) rounds are all there is to find.

Names are 128 bits of hash. Counting and first places combine before the shuffle and are stored; rows of a
frequent line are then joined to its one stored row, a join of two plain shuffles, which the adaptive skew
join splits.

The longest-common-prefix intervals of the method are the sets of equal names: all suffixes that share
their first lines up to a length have one name at that length. Suffixes are never put in order; which copy is
first is asked of places, not of ranks.

Edge cases: null and empty texts have no lines and stay. Blank lines are never deleted and do not
separate runs. Rows equal in ``doc_id`` and text count as one document and get the same text. Rows
without ``doc_id`` come first in the order. ``text`` loses whole lines only; ``n_chars`` follows it
where the table has that column. Other columns pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    words: int = 20


def _key() -> Column:
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _shortest(words: Column, least: int) -> Column:
    """How many of the first ``words`` together reach ``least``; null if all do not."""
    step = lambda acc, w: F.when(acc["sum"] >= least, acc).otherwise(F.struct((acc["sum"] + w).alias("sum"), (acc["n"] + 1).alias("n")))
    none = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    return F.aggregate(words, none, step, lambda acc: F.when(acc["sum"] >= least, acc["n"]))


def line_rows(docs: DataFrame, least: int) -> DataFrame:
    """Rows (k, n, ahead, back, a, b): the n-th line with a word of document k, the lengths of the shortest runs
    of ``least`` words that start and that end with it, and its id (a, b)."""
    lines = docs.select(_key().alias("k"), F.filter(_lines(F.col("text")), lambda x: x.rlike(_WORD)).alias("lines"))
    counted = lines.select("k", "lines", F.transform("lines", lambda x: F.size(F.regexp_extract_all(x, F.lit(_WORD), 0))).alias("words"))
    rows = counted.select("k", "words", F.posexplode("lines").alias("n", "line"))
    here, n = F.get("words", F.col("n")), F.col("n")
    before = F.reverse(F.slice("words", F.greatest(n + 2 - least, F.lit(1)), F.least(n + 1, F.lit(least))))
    return rows.select(
        "k",
        "n",
        F.when(here >= least, 1).otherwise(_shortest(F.slice("words", n + 1, F.lit(least)), least)).alias("ahead"),
        F.when(here >= least, 1).otherwise(_shortest(before, least)).alias("back"),
        F.xxhash64("line").alias("a"),
        F.xxhash64(F.lit(1), "line").alias("b"),
    )


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows whose name occurs at two places or more; ``later`` tells all but the first place."""
    place, rows = F.struct("k", "n"), stored(rows, "named")
    names = rows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    return rows.join(stored(names.select("a", "b", "first"), "names"), ["a", "b"]).withColumn("later", place != F.col("first")).drop("first")


def _between(now: DataFrame, size: int) -> DataFrame:
    """Rows (k, n, length, a, b): the shortest runs of more than ``size`` and less than twice as many lines,
    from the repeated runs of ``size`` lines."""
    ahead = now.where((F.col("ahead") > size) & (F.col("ahead") < 2 * size))
    back = now.where((F.col("back") > size) & (F.col("back") < 2 * size))
    start = F.col("n") + size - F.col("back")
    wanted = ahead.select("k", "n", F.col("ahead").alias("length")).unionByName(back.select("k", start.alias("n"), F.col("back").alias("length")))
    half = now.select("k", "n", "a", "b")
    head = wanted.distinct().join(half, ["k", "n"])
    tail = half.select("k", F.col("n").alias("m"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    both = head.withColumn("m", F.col("n") + F.col("length") - size).join(tail, ["k", "m"])
    return both.select(
        "k", "n", "length", F.xxhash64("length", "a", "b", "a2", "b2").alias("a"), F.xxhash64(F.lit(1), "length", "a", "b", "a2", "b2").alias("b")
    )


def later_copies(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows (k, n): lines that lie in a run which occurs earlier."""
    top = max(0, rule.words.bit_length() - 1)
    now = stored(_repeated(line_rows(docs, max(1, rule.words))).distinct(), "runs-1")
    found = now.where(F.col("later") & (F.col("ahead") == 1)).select("k", "n")

    def lines(runs: DataFrame, length: Column) -> DataFrame:
        return runs.where("later").select("k", F.explode(F.sequence(F.col("n"), F.col("n") + length - 1)).alias("n"))

    for t in range(top):
        half, size = 1 << t, 2 << t
        # A run keeps ``ahead`` of its first line and ``back`` of its last.
        tail = now.select("k", (F.col("n") - half).alias("n"), F.col("back").alias("back2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
        both = now.join(tail, ["k", "n"]).select(
            "k",
            "n",
            "ahead",
            F.col("back2").alias("back"),
            F.xxhash64("a", "b", "a2", "b2").alias("a"),
            F.xxhash64(F.lit(t + 2), "a", "b", "a2", "b2").alias("b"),
        )
        now = stored(_repeated(both), f"runs-{size}")
        found = found.unionByName(lines(now.where((F.col("ahead") == size) | (F.col("back") == size)), F.lit(size)))
        if size < rule.words:
            found = found.unionByName(lines(_repeated(_between(now, size)), F.col("length")))
    return found.distinct()


def _without(text: Column, gone: Column) -> Column:
    """``text`` without its ``gone``-th lines (sorted numbers among the lines with a word)."""

    def kept(lines: Column) -> Column:
        numbered = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(_WORD), i)), lambda i: i.isNotNull())

        def pieces(places: Column) -> Column:
            def piece(j: Column) -> Column:
                start = F.when(j == 0, F.lit(0)).otherwise(F.get(places, j - 1) + 1)
                end = F.coalesce(F.get(places, j), F.size(lines))
                return F.slice(lines, start + 1, end - start)

            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), piece))

        # One-element arrays bind a value once for the lambdas inside.
        places = F.transform(F.array(numbered), lambda all_: F.transform(gone, lambda n: F.get(all_, n)))
        return F.get(F.transform(places, pieces), 0)

    return F.array_join(F.get(F.transform(F.array(_lines(text)), kept), 0), "\n")


def dedup_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows (doc, text, n_lines, n_deleted): ``doc`` holds the row of ``docs`` as it was, ``text``
    what stays of it; both numbers count lines with a word."""
    gone = later_copies(docs, rule).groupBy("k").agg(F.sort_array(F.collect_list("n")).alias("gone"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _key().alias("k"))
    joined = own.join(gone, "k", "left")
    text = F.col("doc.text")
    return joined.select(
        "doc",
        F.when(F.col("gone").isNull(), text).otherwise(_without(text, F.col("gone"))).alias("text"),
        F.coalesce(F.size(F.filter(_lines(text), lambda x: x.rlike(_WORD))), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_deleted"),
    )


def drop_repeated_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with later copies deleted from ``text``; a row of which nothing but blanks is left goes."""
    found = dedup_lines(docs, rule).where((F.col("n_deleted") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_deleted") == 0, F.col("doc.n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None}
    return found.select(
        *[(changed[c] if changed.get(c) is not None else F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )
