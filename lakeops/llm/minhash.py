"""Near-duplicate classes by b-bit MinHash (operator 3).

1. ``signatures``: each text's set of word shingles gives 160 minima. Their low four bits are
   packed into ten longs; runs of five whole minima give 32 band keys. Texts with equal sets form
   one class, named by the MD5 of the sorted set, so copies are never compared with each other.
2. Classes that share a band are candidates. In each band the class with the most company is the
   pivot; every other member is paired with it, never with all others.
3. The share of equal low bits, corrected for chance collisions (1/16), estimates the similarity.
   Pairs far below the threshold go; the rest is settled on the full sets, next to each other in
   one sorted stream per pivot (split by a salt when a pivot has many partners).
4. What a pivot did not connect is not lost: bands whose members still lie in different components
   are compared again, each block of loose members against the band's stream. Tasks
   return a spanning forest of the links they found, not the links.

A pair at the threshold shares no band with probability (1 - 0.8^5)^32 = 3e-6, less above it; an
estimate falls under the margin about as rarely. Nothing is capped: large groups become more
tasks. A task holds the shingle hashes of one pivot or of at most about 256 loose members (8 bytes a
word) and of the one text it compares them with.

Edge cases: null, empty or blank texts have no shingles and stay alone. Rows without ``doc_id``
take part in linking but never name a component; their ``kept`` is true only where nothing with an
id is linked to them. Repeated rows each get their row's result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .store import membership, probably_in, stored
from .words import SPACED, grams, runs

BANDS, ROWS, BITS = 32, 5, 4
MINIMA = BANDS * ROWS
LONGS = MINIMA * BITS // 64
_SEED = np.random.default_rng(20240501)
_FACTOR = (_SEED.integers(0, 1 << 32, MINIMA, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFT = _SEED.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)

BLOCK = 256
PARTNERS_PER_TASK = 512


@dataclass(frozen=True)
class Rule:
    """Link two texts whose shingle sets have intersection / union >= percent / 100."""

    words: int = 5
    percent: int = 80
    margin: float = 0.17  # five standard deviations of the estimate

    def linked(self, both, left, right):
        return 100 * both >= self.percent * (left + right - both)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per row: sorted distinct shingle hashes of the whole lower-cased text (0 for none)."""
    for run in runs(column):
        starts, ends, cut = run.words(SPACED)
        hashes = run.hashes(starts, ends)
        for t in range(run.texts):
            own = hashes[cut[t] : cut[t + 1]]
            if len(own) == 0:
                yield run.first + t, own
            elif len(own) < words:
                yield run.first + t, grams(own, len(own))
            else:
                yield run.first + t, np.unique(grams(own, words))


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(s) for s in sets])
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((MINIMA, len(sets)), dtype=np.uint32)
    for p in range(MINIMA):
        out[p] = np.minimum.reduceat(x * _FACTOR[p] + _SHIFT[p], heads)
    return out.T


def _bands(minima: np.ndarray) -> np.ndarray:
    from .words import mix

    wide = minima.astype(np.uint64).reshape(len(minima), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(minima), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r])
    return out.view(np.int64)


def _packed(minima: np.ndarray) -> np.ndarray:
    low = (minima & np.uint32(15)).astype(np.uint64).reshape(len(minima), LONGS, 16)
    return (low << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).view(np.int64)


_SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, key binary, bands array<bigint>, bits array<bigint>"


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per input row; ``key``, ``bands`` and ``bits`` are null for an empty set."""
    words = rule.words

    def sign(batches):
        for batch in batches:
            ids, text_hash = batch.column(0), batch.column(1)
            at, sets = 0, []
            sizes, keys, bands, bits = [], [], [], []

            def flush():
                full = [s for s in sets if len(s)]
                b = p = iter(())
                if full:
                    m = _minima(full)
                    b, p = iter(_bands(m).tolist()), iter(_packed(m).tolist())
                for s in sets:
                    sizes.append(len(s))
                    keys.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    bands.append(next(b) if len(s) else None)
                    bits.append(next(p) if len(s) else None)
                sets.clear()

            pending = 0
            for _, s in shingle_sets(batch.column(2), words):
                sets.append(s)
                pending += len(s)
                if pending > 1 << 18:
                    flush()
                    pending = 0
                if len(sizes) >= 2048:
                    n = len(sizes)
                    yield _signed(ids, text_hash, at, sizes, keys, bands, bits)
                    at += n
                    sizes, keys, bands, bits = [], [], [], []
            flush()
            if sizes:
                yield _signed(ids, text_hash, at, sizes, keys, bands, bits)

    source = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return source.mapInArrow(sign, _SIGNED)


def _signed(ids, text_hash, at, sizes, keys, bands, bits) -> pa.RecordBatch:
    n = len(sizes)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [ids.slice(at, n), text_hash.slice(at, n), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(bits, longs)],
        ["doc_id", "text_hash", "n_shingles", "key", "bands", "bits"],
    )


def _unequal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of unequal 4-bit fields of packed rows (broadcasting)."""
    x = left ^ right
    x = x | (x >> np.uint64(1))
    x = x | (x >> np.uint64(2))
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=-1)


def _most_unequal(rule: Rule) -> int:
    """Bit fields that may differ while the collision-corrected estimate is within the margin."""
    chance = 1 / (1 << BITS)
    least = max(0.0, rule.percent / 100 - rule.margin)
    return int(MINIMA * (1 - (least * (1 - chance) + chance)))


def _estimate_passes(rule: Rule):
    """The same bound over the array columns ``a_bits`` and ``b_bits``, inside the JVM."""
    total = None
    for i in range(LONGS):
        x = F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        n = F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
        total = n if total is None else total + n
    return total <= F.lit(_most_unequal(rule))


class _Left:
    """The few texts at the head of a group, and a merged index of their shingles."""

    def __init__(self) -> None:
        self.keys: list[bytes] = []
        self.labels: list = []
        self.bits: list = []
        self.sets: list[np.ndarray] = []
        self.index = None

    def add(self, key, label, bits, shingles) -> None:
        self.keys.append(key)
        self.labels.append(label)
        self.bits.append(bits)
        self.sets.append(shingles)

    def close(self) -> None:
        if self.index is not None:
            return
        self.sizes = np.array([len(s) for s in self.sets])
        values = np.concatenate(self.sets)
        owners = np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.index = values[order], owners[order]
        self.words = np.array(self.bits, dtype=np.int64).view(np.uint64)
        self.forest = list(range(len(self.keys)))

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        values, owners = self.index
        low = np.searchsorted(values, shingles, "left")
        n = np.searchsorted(values, shingles, "right") - low
        total = int(n.sum())
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        return np.bincount(owners[at], minlength=len(self.keys))


def _compare(rule: Rule):
    """Sorted rows (g, s, ord, key, label, bits, text) -> links (u, v) between heads and others.

    A head that already joined a right text's component need not be linked again: the links that
    leave a group connect exactly what all links would.
    """
    words, most = rule.words, _most_unequal(rule)

    def task(batches):
        left, group = _Left(), None
        for batch in batches:
            g, salt, order, keys, labels, bits = (batch.column(i).to_pylist() for i in range(6))
            texts = batch.column(6)
            us, vs = [], []
            for i in range(batch.num_rows):
                if (g[i], salt[i]) != group:
                    left, group = _Left(), (g[i], salt[i])
                if order[i] == 0:
                    (_, own), = shingle_sets(texts.slice(i, 1), words)
                    left.add(keys[i], labels[i], bits[i], own)
                    continue
                if not left.keys:
                    continue
                left.close()
                near = _unequal(left.words, np.array(bits[i], dtype=np.int64).view(np.uint64)) <= most
                near &= np.array([k != keys[i] and (x is None or x != labels[i]) for k, x in zip(left.keys, left.labels)])
                if not near.any():
                    continue
                (_, own), = shingle_sets(texts.slice(i, 1), words)
                linked = near & rule.linked(left.shared(own), left.sizes, len(own))
                roots = set()
                for h in np.flatnonzero(linked).tolist():
                    r = h
                    while left.forest[r] != r:
                        r = left.forest[r]
                    if r not in roots:
                        roots.add(r)
                        us.append(keys[i])
                        vs.append(left.keys[h])
                if len(roots) > 1:
                    top = min(roots)
                    for r in roots:
                        left.forest[r] = top
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], ["u", "v"])

    return task


def _links(rows: DataFrame, rule: Rule) -> DataFrame:
    dealt = rows.select("g", "s", "ord", "key", "label", "bits", "text").repartition("g", "s")
    return dealt.sortWithinPartitions("g", "s", "ord").mapInArrow(_compare(rule), "u binary, v binary")


def _texts(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text): one text for each wanted class; other texts are left out before the shuffle."""
    wanted = stored(
        classes.join(keys, "key", "left_semi").select("key", F.col("rep.doc_id").alias("r_id"), F.col("rep.text_hash").alias("r_hash")),
        "wanted",
    )
    passes = membership(wanted, "r_hash")

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(probably_in(passes, batch.column(1).to_numpy(zero_copy_only=False))))

    some = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    some = some.mapInArrow(keep, "doc_id bigint, text_hash bigint, text string")
    found = some.join(wanted, some["doc_id"].eqNullSafe(wanted["r_id"]) & (some["text_hash"] == wanted["r_hash"]))
    return found.select("key", "text").dropDuplicates(["key"])


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component_id, kept
    and group.

    ``component_id`` is the least ``doc_id`` that links lead to; ``kept`` marks its rows. ``group``
    names the component itself, which matters where ids repeat; it is null without shingles.
    """
    signed = stored(signatures(docs, rule), "signatures")
    full = signed.where("key IS NOT NULL")
    classes = stored(
        full.groupBy("key").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"),
            F.min("doc_id").alias("least_id"),
            F.first("bands").alias("bands"),
            F.first("bits").alias("bits"),
        ),
        "classes",
    )
    spread = classes.select("key", F.explode("bands").alias("band"))
    # Stored, like every one-row side below that many rows are joined to: the adaptive skew join splits a
    # join of two plain shuffles only.
    shared = stored(spread.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "bands")
    members = stored(spread.join(shared, "band"), "members")

    company = members.groupBy("key").agg(F.sum("size").alias("company"))
    ranked = members.join(company, "key")
    pivots = ranked.groupBy("band").agg(F.max(F.struct("company", "key")).alias("top")).select("band", F.col("top.key").alias("pivot"))
    pivots = stored(pivots, "pivots")
    pairs = members.join(pivots, "band").where("key <> pivot").select("key", "pivot").distinct()
    bits = classes.select("key", "bits")
    pairs = (
        pairs.join(bits.withColumnRenamed("bits", "a_bits"), "key")
        .join(bits.select(F.col("key").alias("pivot"), F.col("bits").alias("b_bits")), "pivot")
        .where(_estimate_passes(rule))
        .select("key", "pivot", F.col("a_bits").alias("bits"), "b_bits")
    )
    pairs = stored(pairs, "pairs")

    keys = pairs.select("key").unionByName(pairs.select(F.col("pivot").alias("key"))).unionByName(members.where("size > 2").select("key"))
    texts = stored(_texts(docs, classes, keys.distinct()), "texts")

    slices = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PARTNERS_PER_TASK).cast("int").alias("n"), F.first("b_bits").alias("bits"))
    heads = slices.select(F.col("pivot").alias("key"), "bits", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"))
    heads = heads.select(F.col("key").alias("g"), "s", F.lit(0).alias("ord"), "key", "bits")
    others = pairs.join(slices.select("pivot", "n"), "pivot").select(
        F.col("pivot").alias("g"), F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("s"), F.lit(1).alias("ord"), "key", "bits"
    )
    rows = heads.unionByName(others).join(texts, "key").withColumn("label", F.lit(None).cast("binary"))
    links = stored(_links(rows, rule), "links")
    roots = components(links)

    # Bands in which a pivot left something apart.
    labelled = (
        members.where("size > 2")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .select("band", "key", F.coalesce("root", "key").alias("label"))
    )
    labelled = stored(labelled, "labelled")
    by_label = labelled.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    split = by_label.groupBy("band").agg(
        F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels"), F.sum("n").alias("size")
    ).where("labels > 1")
    split = split.select("band", F.col("top.label").alias("main"), F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("n"))
    active = labelled.join(split, "band").withColumn("g", F.col("band").cast("string").cast("binary"))
    loose = active.where("label <> main").select(
        "g", F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("s"), F.lit(0).alias("ord"), "key", "label"
    )
    streams = active.select("g", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"), F.lit(1).alias("ord"), "key", "label")
    rows = loose.unionByName(streams).join(bits, "key").join(texts, "key")
    more = stored(_links(rows, rule), "links")
    roots = stored(components(links.unionByName(more)), "roots")

    named = classes.select("key", "least_id").join(roots.withColumnRenamed("node", "key"), "key", "left")
    named = named.select("key", "least_id", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component"))
    named = stored(named.join(least, "root").select("key", "component", F.col("root").alias("group")), "components")
    out = signed.join(named, "key", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        "group",
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_per_group(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one that names the group.

    Rows without shingles stay. Of repeated rows with one ``doc_id`` in a group a single one stays.
    """
    found = near_duplicates(docs, rule)
    names = docs.columns
    kept = found.where("kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "group").distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.xxhash64("text").alias("text_hash"))
    own = own.join(kept, F.col("doc.doc_id").cast("bigint").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
    order = Window.partitionBy("group").orderBy("id", "hash", F.xxhash64(*[F.col(f"doc.`{c}`").cast("string") for c in names]))
    alone = own.where(F.col("group").isNull()).select("doc")
    first = own.where(F.col("group").isNotNull()).withColumn("n", F.row_number().over(order)).where("n = 1").select("doc")
    return first.unionByName(alone).select(*[F.col(f"doc.`{c}`").alias(c) for c in names])
