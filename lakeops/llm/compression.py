"""Quality rules by compression bands (operator 5).

Text that repeats itself compresses too well, noise not at all; how well plain prose compresses
depends on its length, since a short text gives the coder little to refer to. ``BANDS`` gives the
lowest and highest zstandard ratio (compressed / plain bytes) allowed at each length, read off between
its rows by the logarithm of the length. A text passes if the ratio of its whole is inside the band,
and chunks of ``Rule.chunk`` bytes outside the band of their length make up no more than
``Rule.bad_chunks`` of its bytes; so noise inside a long sound text is seen as well.

The base rule (``base_failed``) and the counts it needs come from the same pass over each whole text.

Edge cases: null counts as the empty text: all counts 0, ratio null, base failed. Texts shorter than
the first band get no verdict from the bands. Repeated rows are judged each. Other columns are unused.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import SPACED, Run, grams, mix, runs

# bytes, lowest ratio, highest ratio; set around labelled sound texts with some room
BANDS = (
    (256, 0.512, 1.00),
    (512, 0.505, 0.85),
    (724, 0.490, 0.78),
    (1024, 0.477, 0.72),
    (1448, 0.460, 0.69),
    (2048, 0.450, 0.66),
    (2896, 0.443, 0.63),
    (4096, 0.432, 0.60),
    (8192, 0.412, 0.57),
    (16384, 0.402, 0.55),
    (32768, 0.390, 0.55),
    (65536, 0.385, 0.55),
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rule:
    bands: tuple[tuple[int, float, float], ...] = BANDS
    level: int = 3
    chunk: int = 4096
    bad_chunks: float = 0.25

    def outside(self, size: int, ratio: float) -> bool:
        if size < self.bands[0][0]:
            return False
        at = np.log2(size)
        x = [np.log2(b[0]) for b in self.bands]
        return not np.interp(at, x, [b[1] for b in self.bands]) <= ratio <= np.interp(at, x, [b[2] for b in self.bands])


def _per_text(run: Run, flags: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[run.offsets[1:]] - sums[run.offsets[:-1]]


def _base(run: Run) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text of a run."""
    data = run.data
    if len(data) == 0:
        return (np.zeros(run.texts, dtype=np.int64),) * 5
    starts, ends, cut = run.words(SPACED)
    n_words = np.diff(cut)
    owner = np.repeat(np.arange(run.texts), n_words)
    first_byte = (data & 0xC0) != 0x80
    chars = _per_text(run, first_byte & SPACED[data])

    breaks = np.flatnonzero(data == 10)
    heads = np.union1d(breaks + 1, run.offsets[:-1])
    heads = heads[heads < len(data)]
    tails = np.append(heads[1:], len(data))
    last = np.minimum(tails, len(data)) - 1
    tails = np.where(data[last] == 10, last, tails)
    filled = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails = heads[filled], tails[filled]
    line_owner = np.searchsorted(run.offsets, heads, side="right") - 1
    key = mix(run.hashes(heads, tails) ^ mix(line_owner.astype(np.uint64) + np.uint64(1)))
    _, at = np.unique(key, return_index=True)
    again = np.ones(len(key), dtype=bool)
    again[at] = False
    dup_lines = np.bincount(line_owner[again], minlength=run.texts)

    repeats = np.zeros(len(owner) + 1, dtype=np.int64)
    g = grams(run.hashes(starts, ends), 3)
    if len(g):
        inside = np.flatnonzero(owner[: len(g)] == owner[2:])
        key = mix(g[inside] ^ mix(owner[inside].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(repeats, inside[twice], 1)
        np.add.at(repeats, inside[twice] + 3, -1)
    repeat_words = np.bincount(owner[np.cumsum(repeats)[:-1] > 0], minlength=run.texts)
    return n_words, chars, _per_text(run, _SYMBOL[data]), dup_lines, repeat_words


def quality(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, ratio, bad_bytes (in chunks outside their band), in_band."""

    def task(batches):
        coder = zstandard.ZstdCompressor(level=rule.level)

        def size(piece) -> int:
            return len(coder.compress(piece))

        for batch in batches:
            counts = [np.zeros(batch.num_rows, dtype=np.int64) for _ in range(5)]
            ratio, bad, good = [], [], []
            for run in runs(batch.column(1), lower=False):
                rows = slice(run.first, run.first + run.texts)
                for out, values in zip(counts, _base(run)):
                    out[rows] = values
                for a, b in zip(run.offsets[:-1].tolist(), run.offsets[1:].tolist()):
                    n = b - a
                    if n == 0:
                        ratio.append(None)
                        bad.append(0)
                        good.append(True)
                        continue
                    whole = size(run.data[a:b]) / n
                    outside = 0
                    if n > rule.chunk:
                        for i in range(a, b, rule.chunk):
                            piece = run.data[i : min(b, i + rule.chunk)]
                            if rule.outside(len(piece), size(piece) / len(piece)):
                                outside += len(piece)
                    ratio.append(whole)
                    bad.append(outside)
                    good.append(not rule.outside(n, whole) and outside <= rule.bad_chunks * n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(ratio, pa.float64()), pa.array(bad, pa.int64()), pa.array(good, pa.bool_())],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "bad_bytes", "in_band"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        task, f"doc_id {kind}, {longs}, ratio double, bad_bytes bigint, in_band boolean"
    )
