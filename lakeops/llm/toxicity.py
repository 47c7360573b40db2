"""Toxicity by a factorization machine over hashed terms (operator 8).

Terms are words and their first 4 to 8 bytes (which catch families of words), hashed to 2^18 slots; a
text is the set of its slots. The score of slots x is

    logistic(w0 + sum_i w_i + 1/2 * sum_f ((sum_i v_if)^2 - sum_i v_if^2)),

so two slots may say together what neither says alone. Learning uses at most
``Settings.sample`` labelled rows, chosen by the hash of their id, outside the held-out
quarter; equal texts count once. Two kinds of slots enter the model: those that go with the label (or
against it) more than chance allows, by whatever factor, at most ``Settings.kept_slots``; and both slots of every
pair that says more together than apart, whether or not either alone goes with the label. Pairs are
screened among the ``Settings.paired_slots`` slots that vary most over the sample. The fit runs on the sample's kept
slots only, a few MB; scoring covers every whole text.

Edge cases: a null or empty text has no slots and gets the base rate. Without labels, or with labels
of one kind, the model is that base rate, (toxic + 0.05) / (rows + 1). Labels that are null, or have
no id, are not learned from; of several labels for one id the toxic one counts. Rows without
``doc_id`` are scored and not held out. Repeated rows are scored each. Other columns are unused.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored
from .words import ALNUM, Run, mix, runs

SLOT_BITS = 18
PREFIXES = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Settings:
    sample: int = 12_000
    least_rows: int = 4
    least_z: float = 3.0
    kept_slots: int = 2048
    paired_slots: int = 2048
    least_pair_z: float = 6.0  # some two million pairs are looked at
    factors: int = 8
    steps: int = 2000
    batch: int = 256
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    base: float
    slots: np.ndarray  # kept slot numbers
    weights: np.ndarray
    factors: np.ndarray

    def index(self) -> np.ndarray:
        out = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        out[self.slots] = np.arange(len(self.slots), dtype=np.int32)
        return out

    def scores(self, texts: pa.Array, index: np.ndarray) -> np.ndarray:
        """Score of every text of a batch."""
        squares = (self.factors**2).sum(axis=1)
        z = np.full(len(texts), self.base)
        for run, owners, slots in _slot_sets(texts, index):
            if len(slots) == 0:
                continue
            heads = np.flatnonzero(np.diff(owners, prepend=-1))
            linear = np.add.reduceat(self.weights[slots] - 0.5 * squares[slots], heads)
            sums = np.add.reduceat(self.factors[slots], heads, axis=0)
            z[run.first + owners[heads]] += linear + 0.5 * (sums**2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _terms(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Text number and slot of every term of a run."""
    accented = np.flatnonzero(run.data[:-1] == 0xC3) + 1
    upper = accented[(run.data[accented] >= 0x80) & (run.data[accented] <= 0x9E) & (run.data[accented] != 0x97)]
    run.data[upper] += 32
    starts, ends, cut = run.words(ALNUM)
    owner = np.repeat(np.arange(run.texts), np.diff(cut))
    shift = np.uint64(64 - SLOT_BITS)
    owners, slots = [owner], [(run.hashes(starts, ends) >> shift).astype(np.int64)]
    size = ends - starts
    for n in PREFIXES:
        long = size >= n
        owners.append(owner[long])
        slots.append((mix(run.hashes(starts[long], starts[long] + n) + np.uint64(n)) >> shift).astype(np.int64))
    return np.concatenate(owners), np.concatenate(slots)


def _slot_sets(column: pa.Array, index: np.ndarray | None):
    """Per run: first row, and sorted distinct (text, slot or kept slot's number) pairs."""
    for run in runs(column):
        owners, slots = _terms(run)
        if index is not None:
            slots = index[slots]
            known = slots >= 0
            owners, slots = owners[known], slots[known]
        pairs = np.unique((owners.astype(np.int64) << SLOT_BITS) | slots)
        yield run, pairs >> SLOT_BITS, pairs & ((1 << SLOT_BITS) - 1)


def _sample_slots(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Stored (toxic, slots) of the sample; its ids are few by definition, so they are broadcast."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(s.sample)
    )
    chosen = stored(chosen, "label-sample")

    def task(batches):
        for batch in batches:
            toxic, text_hash = batch.column(0), batch.column(1)
            for run, owners, slots in _slot_sets(batch.column(2), None):
                cut = np.searchsorted(owners, np.arange(run.texts + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(slots.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [toxic.slice(run.first, run.texts), text_hash.slice(run.first, run.texts), lists], ["toxic", "text_hash", "slots"]
                )

    rows = docs.join(F.broadcast(chosen), "doc_id").select("toxic", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    rows = stored(rows.mapInArrow(task, "toxic int, text_hash bigint, slots array<int>"), "sample-slots")
    return rows.groupBy("text_hash").agg(F.max("toxic").alias("toxic"), F.first("slots").alias("slots")).select("toxic", "slots")


def _pair_strength(toxic: np.ndarray, rows: list[np.ndarray], n_slots: int, s: Settings) -> np.ndarray:
    """For each slot the largest |z| of the contrast p11 - p10 - p01 + p00 of toxic shares over its pairs."""
    both, hits = (np.zeros((n_slots, n_slots), dtype=np.float32) for _ in range(2))  # counts below 2^24 are exact
    for i in range(0, len(rows), 1024):  # the whole sample as one matrix would take 100 MB of the driver
        x = np.zeros((min(1024, len(rows) - i), n_slots), dtype=np.float32)
        for j, row in enumerate(rows[i : i + 1024]):
            x[j, row] = 1
        both += x.T @ x
        x = x[toxic[i : i + 1024] == 1]
        hits += x.T @ x
    n, pos = np.diag(both).astype(float), np.diag(hits).astype(float)
    total, positive, best = len(rows), float(toxic.sum()), np.zeros(n_slots)
    share = positive / total
    for at in range(0, n_slots, 64):
        part = slice(at, at + 64)
        n11, p11 = both[part].astype(float), hits[part].astype(float)
        n10, n01, p10, p01 = n[part, None] - n11, n[None] - n11, pos[part, None] - p11, pos[None] - p11
        n00, p00 = total - n11 - n10 - n01, positive - p11 - p10 - p01
        enough = np.minimum(np.minimum(n11, n10), np.minimum(n01, n00)) >= s.least_rows
        n11, n10, n01, n00 = (np.maximum(c, 1) for c in (n11, n10, n01, n00))
        contrast = np.abs(p11 / n11 - p10 / n10 - p01 / n01 + p00 / n00)
        z = contrast / np.sqrt(share * (1 - share) * (1 / n11 + 1 / n10 + 1 / n01 + 1 / n00))
        best[part] = np.where(enough, z, 0).max(axis=1)
    return best


def _fit(toxic: np.ndarray, rows: list[np.ndarray], n_slots: int, s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss in shuffled mini-batches, with a falling rate."""
    rng = np.random.default_rng(s.seed)
    rate = float(toxic.mean())
    w0 = np.array([np.log(rate / (1 - rate))])
    w = np.zeros(n_slots)
    v = rng.normal(0, 0.02, (n_slots, s.factors))
    params = [w0, w, v]
    m, q = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    while step < s.steps:
        order = rng.permutation(len(rows))
        for at in range(0, len(order), s.batch):
            pick = order[at : at + s.batch]
            sizes = np.array([len(rows[i]) for i in pick])
            flat = np.concatenate([rows[i] for i in pick]) if sizes.sum() else np.zeros(0, dtype=np.int64)
            own = np.repeat(np.arange(len(pick)), sizes)
            sums = np.zeros((len(pick), s.factors))
            np.add.at(sums, own, v[flat])
            linear = np.bincount(own, weights=w[flat] - 0.5 * (v[flat] ** 2).sum(axis=1), minlength=len(pick))
            z = w0[0] + linear + 0.5 * (sums**2).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic[pick]
            gw = np.bincount(flat, weights=error[own], minlength=n_slots) / len(pick)
            gv = np.zeros_like(v)
            np.add.at(gv, flat, error[own][:, None] * (sums[own] - v[flat]))
            grads = [np.array([error.mean()]), gw + s.decay * w, gv / len(pick) + s.decay * v]
            step += 1
            rate_now = s.rate * max(0.02, 1 - step / s.steps)
            for p, g, a, b in zip(params, grads, m, q):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate_now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return float(w0[0]), w, v


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Learn from labels (doc_id, toxic) on ``docs`` (doc_id, text)."""
    rows = stored(_sample_slots(docs, labels, s), "sample-rows")
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    none = Model(float(np.log((positive + 0.05) / (n - positive + 0.95))), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, s.factors)))
    if positive in (0, n):
        return none
    share = positive / n
    z = (F.col("pos") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    counts = (
        rows.select("toxic", F.explode("slots").alias("slot"))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos"))
        .where(F.col("n") >= s.least_rows)
        .withColumn("z", F.abs(z))
    )
    counts = stored(counts, "slot-counts")
    alone = counts.where(F.col("z") >= s.least_z).orderBy(F.desc("z"), "slot").limit(s.kept_slots).toPandas()["slot"].to_numpy(dtype=np.int64)
    varied = counts.orderBy(F.desc(F.col("n") * (F.lit(n) - F.col("n"))), "slot").limit(s.paired_slots).toPandas()["slot"].to_numpy(dtype=np.int64)

    def narrowed(slots: np.ndarray):
        """The sample with numbers for ``slots``: at most Settings.sample rows of as many numbers."""
        index = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        index[slots] = np.arange(len(slots), dtype=np.int32)

        def task(batches):
            for batch in batches:
                lists = [index[np.asarray(x, dtype=np.int64)] for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([x[x >= 0].tolist() for x in lists], pa.list_(pa.int32()))], ["toxic", "slots"]
                )

        sample = rows.orderBy(F.xxhash64("slots"), "toxic").mapInArrow(task, "toxic int, slots array<int>").toArrow()
        lists = sample.column("slots").combine_chunks()
        flat, cut = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        return sample.column("toxic").to_numpy().astype(float), [flat[a:b] for a, b in zip(cut, cut[1:])]

    # One pass gives the numbers for both steps.
    wanted = np.union1d(alone, varied)
    if len(wanted) == 0:
        return none
    toxic, lists = narrowed(wanted)

    def only(slots: np.ndarray) -> list[np.ndarray]:
        index = np.full(len(wanted), -1, dtype=np.int32)
        index[np.searchsorted(wanted, slots)] = np.arange(len(slots))
        return [x[x >= 0] for x in (index[row] for row in lists)]

    varied = np.sort(varied)
    paired = varied[_pair_strength(toxic, only(varied), len(varied), s) >= s.least_pair_z]
    slots = np.union1d(alone, paired)
    if len(slots) == 0:
        return none
    w0, w, v = _fit(toxic, only(slots), len(slots), s)
    return Model(w0, slots, w, v)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, score (0 to 1)."""

    def task(batches):
        index = model.index()
        for batch in batches:
            scores = pa.array(model.scores(batch.column(2), index))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], ["doc_id", "text_hash", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return source.mapInArrow(task, f"doc_id {kind}, text_hash bigint, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, s: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, in one pass over the texts."""
    model = train(docs, labels, s)
    at = docs.columns.index("text")

    def task(batches):
        index = model.index()
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at), index) < threshold))

    return docs.mapInArrow(task, docs.schema)
