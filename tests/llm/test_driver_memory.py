"""What the toxicity fit holds on the driver: counts of slot pairs, not the sample as a matrix."""

from __future__ import annotations

import tracemalloc

import numpy as np

from lakeops.llm import toxicity
from lakeops.llm.toxicity import Settings


def _sample(n_rows, n_slots, share):
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(n_slots) < share).astype(np.int32) for _ in range(n_rows)]
    return (rng.random(n_rows) < 0.3).astype(float), rows


def test_pairs_are_screened_in_a_few_megabytes():
    s = Settings()
    toxic, rows = _sample(s.sample, s.paired_slots, 0.01)
    tracemalloc.start()
    toxicity._pair_strength(toxic, rows, s.paired_slots, s)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # 12,000 x 2,048 numbers alone are 98 MB


def test_blocks_of_rows_give_the_contrast_of_the_whole_sample():
    s = Settings()
    toxic, rows = _sample(2500, 90, 0.2)
    x = np.zeros((2500, 90), dtype=bool)
    for i, row in enumerate(rows):
        x[i, row] = True
    best = toxicity._pair_strength(toxic, rows, 90, s)
    share = toxic.mean()
    for a in (0, 63, 64, 89):
        found = 0.0
        for b in range(90):
            cells = [x[:, a] & x[:, b], x[:, a] & ~x[:, b], ~x[:, a] & x[:, b], ~x[:, a] & ~x[:, b]]
            n = [c.sum() for c in cells]
            if min(n) >= s.least_rows:
                p = [toxic[c].mean() for c in cells]
                z = abs(p[0] - p[1] - p[2] + p[3]) / np.sqrt(share * (1 - share) * sum(1 / k for k in n))
                found = max(found, z)
        assert abs(best[a] - found) < 1e-9
