"""Words of whole texts as numpy arrays, straight from Arrow string columns.

Used inside ``mapInArrow`` tasks. Texts are taken in runs of bounded size (``runs``), so memory
follows the longest single text, not the batch. Null texts have no words. Only ASCII bytes
separate words, hence byte masks are exact on UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
_STEP = 1 << 21

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ on text whose A-Z are lower-cased
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = 0x9E3779B97F4A7C15
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection on 64 bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            ones = np.ones(size, dtype=np.uint64)
            up, down = ones.copy(), ones.copy()
            up[1:] = _BASE
            down[1:] = pow(_BASE, -1, 1 << 64)
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_POWERS = _Powers()


class Run:
    """Consecutive texts of a batch: lower-cased bytes and where each text starts and ends."""

    def __init__(self, first: int, offsets: np.ndarray, data: np.ndarray) -> None:
        self.first, self.offsets, self.data = first, offsets, data

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def words(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and for each text the number of words before it."""
        inside = member[self.data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        bounds = self.offsets[self.offsets < len(inside)]
        before[bounds] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        last = self.offsets[self.offsets > 0] - 1
        after[last] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte span; equal bytes give equal hashes."""
        out = np.empty(len(starts), dtype=np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + _STEP)))
            base = starts[i]
            piece = self.data[base : int(ends[i:j].max())].astype(np.uint64) + np.uint64(1)
            up, down = _POWERS.get(len(piece) + 1)
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(piece * up[: len(piece)], out=sums[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mix((sums[b] - sums[a]) * down[a])
            i = j
        return out

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")


def runs(column: pa.Array, lower: bool = True, limit: int = RUN_BYTES) -> Iterator[Run]:
    """Split a batch's text column into runs of at most ``limit`` bytes; a longer text is alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, index, data = column.buffers()
    offsets = np.frombuffer(index, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        piece = data[offsets[i] : offsets[j]]
        yield Run(i, offsets[i : j + 1] - offsets[i], LOWER[piece] if lower else piece)
        i = j


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes (order matters); ``len - k + 1`` of them."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:m].copy()
    for j in range(1, k):
        out *= _NEXT
        out += words[j : j + m]
    return mix(out + np.uint64(k))
