"""Sketches bound the difference of two shingle sets from below, whatever their sizes, and drop most unlike pairs."""

import numpy as np

from quire.llm import simhash


def test_sketches_bound_differences():
    r = np.random.default_rng(1)
    for n in (0, 1, 5, 31, 32, 33, 500, 3000, 20_000):
        for m in (0, 1, 40, n // 4, n, 3 * n):
            both, left, right = (np.unique(r.integers(0, 1 << 63, k).astype(np.uint64) << np.uint64(1)) for k in (n, m, m // 2))
            a, b = np.union1d(both, left), np.union1d(both, right)
            least = simhash.differ(simhash.sketch(a), simhash.sketch(b))
            assert least <= len(np.setxor1d(a, b)) and least == simhash.differ(simhash.sketch(b), simhash.sketch(a))
            assert simhash.differ(simhash.sketch(a), simhash.sketch(a)) == 0


def test_sketches_drop_unlike_pairs_of_long_texts():
    """Parities of 512 classes can't: sets of 5,000 differ in about 256 of them, below the bound."""
    r = np.random.default_rng(2)
    both, left, right = (np.unique(r.integers(0, 1 << 63, k).astype(np.uint64) << np.uint64(1)) for k in (4000, 1000, 1000))
    a, b = np.union1d(both, left), np.union1d(both, right)  # 0.67 alike
    bound = 0.2 / 1.8 * (len(a) + len(b))
    assert simhash.differ(simhash.sketch(a), simhash.sketch(b)) > bound
    assert int(np.bitwise_count(simhash.parities(a) ^ simhash.parities(b)).sum()) < bound
