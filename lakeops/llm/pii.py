"""Personal data by bootstrapped contextual extraction (operator 10, built-in functions only).

Patterns for e-mail, IP, card and phone numbers give the base spans. Whole spans, normalised, are the
seeds: instances of identifiers, of any length and however they are spaced. Other instances are tokens with
a digit or @ that touch no base span and have ``Rule.least_chars`` characters. The word before a token, or
before the token that a span starts in, is its context; several spans in one token share its weight. Contexts
and instances form a graph. Rounds go back and forth until one changes nothing: a context's score is the summed confidence of the instances that
follow it, over all its occurrences before any word of the corpus; a context with ``Rule.support``
distinct confident instances and a score of ``Rule.score`` or more is trusted, and gives its score
to every identifier-like token (one with a digit or @) that follows it. Tokens whose confidence passes
``Rule.score`` are personal data wherever they stand, of the kind that their context leads to most.

Places come from built-in functions alone: the pieces between the matches and the matches themselves
alternate, so running sums of their lengths are the starts. All rules on long runs are possessive or
anchored, hence linear and without recursion on texts of any length.

Edge cases: null counts as empty and has no spans. Rows equal in ``doc_id`` and text count once as
evidence and get the same result each. Found tokens never touch a base span. Places are code points,
end exclusive. Other columns are unused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

# Scores count in steps of this part, so that rounds come to an end by themselves.
_STEPS = 1024

KINDS = ("email", "ip", "card", "phone")

# The base rules, in a form that Java's matcher runs without recursion or repeated scans:
# possessive where nothing can be given back; a match can only start where its run of
# characters starts, or where the previous match ended (\G).
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TOKEN = r"(?<!\S)\S*[0-9@]\S*"
_LEAD, _TRAIL = r"^[\"'(\[{<]+", r"[.,;:!?\"')\]}>|#*$%&]+$"


@dataclass(frozen=True)
class Rule:
    support: int = 3
    score: float = 0.6
    least_chars: int = 5


def _last_word(piece: Column) -> Column:
    """The last word of a piece of any length; most often its last 200 characters show it whole."""
    near = F.regexp_extract(F.right(piece, F.lit(200)), r"\s(\S++)\s*+$", 1)
    blank = F.translate(piece, "\t\n\x0b\f\r", "     ")
    return F.when(near != "", near).otherwise(F.substring_index(F.rtrim(blank), " ", -1))


def _matches(rows: DataFrame, pattern: str, found: Column) -> DataFrame:
    """Rows (id, h, i, gap, before, match) of ``rows`` (id, h, text) where ``found`` holds: the i-th
    match, the length of the piece before it and that piece's last word."""
    pairs = F.arrays_zip(
        F.transform(F.split("text", pattern, -1), lambda p: F.struct(F.length(p).alias("n"), _last_word(p).alias("word"))).alias("piece"),
        F.regexp_extract_all("text", F.lit(pattern), 0).alias("match"),
    )
    out = rows.where(found).select("id", "h", F.posexplode(pairs).alias("i", "x"))
    return out.where("x.match IS NOT NULL").select(
        "id", "h", "i", F.col("x.piece.n").alias("gap"), F.col("x.piece.word").alias("before"), F.col("x.match").alias("match")
    )


def _with_starts(rows: DataFrame, *by: str) -> DataFrame:
    """Adds start and end. Rows of repeated documents are equal and count once."""
    order = Window.partitionBy("id", "h", *by).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(order)
    return rows.distinct().withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))


def _luhn(digits: Column) -> Column:
    """Whether a string of up to 19 digits passes the check sum."""

    def term(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), term), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str) -> Column:
    match = F.col("match")
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(match, r"[\x20-]", "")
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _normal(kind: str) -> Column:
    """A span as an instance: one value however it is written."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    return {"email": F.lower("match"), "ip": F.col("match"), "card": digits, "phone": F.concat(F.lit("+"), digits)}[kind]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def base_spans(docs: DataFrame) -> DataFrame:
    """Rows (id, h, kind, start, end, value): ``kind`` is a number, in the order of ``KINDS``."""
    rows, out = _keyed(docs), None
    for number, kind in enumerate(KINDS):
        needs = F.col("text").contains(_NEEDS[kind]) if _NEEDS[kind] else F.col("text").rlike("[0-9]{2}|[0-9][ -][0-9]")
        found = _matches(rows, _PATTERNS[kind], needs & F.col("text").rlike(_PATTERNS[kind])).withColumn("kind", F.lit(number))
        found = found.withColumn("ok", _valid(kind)).withColumn("value", _normal(kind))
        out = found if out is None else out.unionByName(found)
    return _with_starts(out.drop("before"), "kind").where("ok").select("id", "h", "kind", F.col("start").cast("int"), F.col("end").cast("int"), "value")


def _tokens(docs: DataFrame) -> DataFrame:
    """Rows (id, h, start, end, context, value) of identifier-like tokens, ends trimmed."""
    rows = _keyed(docs)
    found = _with_starts(_matches(rows, _TOKEN, F.col("text").rlike("[0-9@]")))
    order = Window.partitionBy("id", "h").orderBy("i")
    context = F.lower(F.when(F.col("before") != "", F.col("before")).otherwise(F.coalesce(F.lag("match").over(order), F.lit(""))))
    lead = F.length(F.regexp_extract("match", _LEAD, 0))
    body = F.regexp_replace(F.regexp_replace("match", _LEAD, ""), _TRAIL, "")
    return found.select(
        "id", "h", (F.col("start") + lead).cast("int").alias("start"), (F.col("start") + lead + F.length(body)).cast("int").alias("end"),
        context.alias("context"), F.lower(body).alias("value"),
    )


def _state(trust: DataFrame) -> tuple:
    """Number of instances and sum of their confidence in whole steps; neither ever falls."""
    return tuple(trust.agg(F.count(F.lit(1)), F.sum(F.round(F.col("trust") * _STEPS).cast("bigint"))).first())


def _seeded(tokens: DataFrame, base: DataFrame) -> DataFrame:
    """``tokens`` with ``base``, whether a base span touches them, and ``seeds``, the spans that start in them.

    Both are sorted by place within their document and looked at once: the farthest end of the spans so
    far and the next span tell whether one touches, the token before tells where a span starts.
    """
    places = tokens.withColumns({"span": F.lit(False), "kind": F.lit(None).cast("int")}).unionByName(
        base.select("id", "h", "start", "end", F.lit(None).cast("string").alias("context"), "value", F.lit(True).alias("span"), "kind")
    )
    own = Window.partitionBy("id", "h")
    ahead = own.orderBy(F.col("start"), F.col("span").desc()).rowsBetween(Window.unboundedPreceding, 0)
    behind = own.orderBy(F.col("start").desc(), F.col("span")).rowsBetween(Window.unboundedPreceding, 0)
    inside = own.orderBy(F.col("start"), F.col("span")).rowsBetween(Window.unboundedPreceding, 0)
    a_span = F.col("span")
    places = places.withColumns(
        {
            "reached": F.max(F.when(a_span, F.col("end"))).over(ahead),
            "next": F.last(F.when(a_span, F.col("start")), True).over(behind),
            "token": F.last(F.when(~a_span, F.struct("start", "end")), True).over(inside),
        }
    )
    seeds = places.where(a_span & (F.col("token.end") > F.col("start")))
    seeds = seeds.groupBy("id", "h", F.col("token.start").alias("start")).agg(F.collect_set(F.struct("kind", "value")).alias("seeds"))
    seeds = seeds.select(F.col("id").alias("s_id"), F.col("h").alias("s_h"), F.col("start").alias("s_start"), "seeds")
    touched = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    out = places.where(~a_span).select("id", "h", "start", "end", "context", "value", touched.alias("base"))
    found = out.join(seeds, out["id"].eqNullSafe(F.col("s_id")) & (out["h"] == F.col("s_h")) & (out["start"] == F.col("s_start")), "left")
    return found.select("id", "h", "start", "end", "context", "value", F.coalesce("seeds", F.array().cast("array<struct<kind:int,value:string>>")).alias("seeds"), "base")


def found_spans(docs: DataFrame, base: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows (id, h, kind, start, end) that trusted contexts add to ``base``."""
    tokens = stored(_seeded(stored(_tokens(docs), "tokens"), base), "instances")

    # The graph, and how often each context stands before any word at all.
    seeds = tokens.where("base").select("context", (1 / F.size("seeds")).alias("n"), F.explode("seeds").alias("seed"))
    seeds = seeds.select("context", "seed.value", "seed.kind", "n")
    others = tokens.where(~F.col("base") & (F.length("value") >= rule.least_chars)).select("context", "value", F.lit(1.0).alias("n"))
    edges = seeds.drop("kind").unionByName(others).where(F.col("context") != "").groupBy("context", "value").agg(F.sum("n").alias("n"))
    edges = stored(edges, "all-edges")
    wide = edges.groupBy("context").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") >= rule.support).select("context")
    edges = stored(edges.join(stored(wide, "wide"), "context"), "edges")
    words = _keyed(docs).select(F.explode(F.split(F.lower("text"), r"[ \t\n\x0B\f\r]+")).alias("context"))
    totals = words.groupBy("context").agg(F.count(F.lit(1)).alias("total")).join(edges.select("context").distinct(), "context")
    totals = stored(totals, "totals")

    trust = stored(seeds.groupBy("value").agg(F.min("kind").alias("kind"), F.lit(1.0).alias("trust")), "trust")
    state = None
    while state != (state := _state(trust)):
        known = edges.join(trust, "value")
        by_kind = known.groupBy("context", "kind").agg(F.sum(F.col("n") * F.col("trust")).alias("mass"), F.count(F.lit(1)).alias("values"))
        contexts = by_kind.groupBy("context").agg(
            F.sum("mass").alias("mass"), F.sum("values").alias("values"), F.max(F.struct("mass", (-F.col("kind")).alias("kind"))).alias("top")
        )
        contexts = contexts.join(totals, "context").where(F.col("values") >= rule.support)
        score = F.floor(F.least(F.lit(1.0), F.col("mass") / F.col("total")) * _STEPS) / _STEPS
        contexts = contexts.select("context", score.alias("score"), (-F.col("top.kind")).alias("lead"))
        contexts = stored(contexts.where(F.col("score") >= rule.score), "contexts")
        reached = edges.join(contexts, "context").groupBy("value").agg(F.max(F.struct("score", (-F.col("lead")).alias("lead"))).alias("best"))
        reached = reached.select("value", F.col("best.score").alias("trust"), (-F.col("best.lead")).alias("kind"))
        seen = trust.select("value", F.col("trust").alias("old"), F.col("kind").alias("old_kind"))
        trust = stored(
            seen.join(reached, "value", "full").select(
                "value", F.coalesce("old_kind", "kind").cast("int").alias("kind"), F.greatest("old", "trust").alias("trust")
            ),
            "trust",
        )
    # Base spans stay as they are; what they touch is not added.
    fresh = tokens.where(~F.col("base") & (F.length("value") >= rule.least_chars)).select("id", "h", "start", "end", "value")
    return fresh.join(trust.where(F.col("trust") >= rule.score), "value").select("id", "h", "kind", "start", "end")


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, base and spans (sorted arrays of kind, start, end)."""
    base = stored(base_spans(docs), "base-spans")
    every = base.drop("value").withColumn("base", F.lit(True)).unionByName(found_spans(docs, base, rule).withColumn("base", F.lit(False)))
    span = F.struct("kind", "start", "end")
    lists = every.groupBy("id", "h").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.array_sort(F.collect_list(span)).alias("spans")
    )
    ids = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    joined = ids.join(lists, ids["doc_id"].eqNullSafe(lists["id"]) & (ids["text_hash"] == lists["h"]), "left")
    return joined.select("doc_id", "text_hash", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans, and all spans as text."""

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint").alias(f"n_{KINDS[number]}")

    counts = [count(number) for number in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
