"""Pairs of words are counted in memory for different pairs."""

import tracemalloc

import numpy as np

from regiostat.llm import toxicity


def test_pair_counts_hold_different_pairs_only():
    rng = np.random.default_rng(0)
    common = np.sort(rng.choice(5_000, 120, replace=False)).astype(np.int64)
    rows, label = [common] * 3_000 + [np.sort(rng.choice(5_000, 20, replace=False)).astype(np.int64) for _ in range(3_000)], np.repeat([1.0, 0.0], 3_000)
    tracemalloc.start()
    found = toxicity.separating_words(label, rows, 8, 6.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(common) <= set(found) and peak < 400e6, peak


def test_pairs_of_long_rows_in_pieces():
    long = np.arange(2_500, dtype=np.int64)
    label, rows = np.repeat([1.0, 0.0], 40), [long] * 40 + [long + 2_500] * 40
    assert toxicity.separating_words(label, rows, 8, 6.0).tolist() == list(range(5_000))
