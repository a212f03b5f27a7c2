"""The packing plan finds every exact fill, however few copies of a length are left."""

from itertools import combinations_with_replacement

import numpy as np

from upcharts.llm.packing import _Available, plan_packing


def _exact_exists(counts, gap, used):
    lengths = [int(x) for x in np.flatnonzero(counts) if x <= gap]
    for size in (1, 2, 3):
        for found in combinations_with_replacement(lengths, size):
            if sum(found) == gap and all(counts[x] >= (used + list(found)).count(x) for x in found):
                return True
    return False


def test_exact_fills_are_never_passed_over():
    random = np.random.default_rng(6)
    for _ in range(300):
        counts = np.zeros(65, np.int64)
        counts[random.integers(1, 30, random.integers(1, 16))] = 1
        length = int(random.integers(20, 60))
        counts[length] += 1
        gap = 64 - length
        found = _Available(counts).exact(gap, [length])
        assert (found is not None) == _exact_exists(counts, gap, [length])
        if found:
            assert sum(found) == gap and _Available(counts).has([length, *found])


def test_last_candidates_without_copies_do_not_end_the_search():
    # the gap is 12: pairs 6 + 6 and triples 4 + 4 + 4 lack copies, 3 + 4 + 5 is there
    counts = np.zeros(33, np.int64)
    counts[[3, 4, 5, 6, 20]] = 1
    assert sorted(_Available(counts).exact(12, [20])) == [3, 4, 5]
    assert plan_packing(counts, 32)[0] == ([20, 5, 4, 3], 1)
