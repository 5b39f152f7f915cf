"""What maintained bounds save, and that they never change a result."""

import numpy as np
import pytest

from tidemark.llm import exact_topk


def plain(ids, v, q, own, k):
    scores = v @ q
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return ids[order], scores[order]


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_change_a_result(seed):
    rng = np.random.default_rng(seed)
    n, width = int(rng.integers(1, 900)), int(rng.integers(1, 20))
    v = rng.integers(-40, 40, (n, width)) * (rng.random((n, 1)) ** 6 * 100 + 1).astype(int)
    v[rng.random(n) < 0.3] = v[0]  # many ties
    ids = rng.permutation(n * 2)[:n]
    asked = np.concatenate([v[: min(n, 40)], np.zeros((1, width), dtype=int), -v[:1]])
    names = np.concatenate([ids[: min(n, 40)], [-1, -2]])
    for k in (1, 5):
        for q, own, (found, score) in zip(asked, names, exact_topk.Lists(ids, v).best(asked, names, k), strict=True):
            want, scores = plain(ids, v, q, own, k)
            assert found.tolist() == want.tolist() and score.tolist() == scores.tolist()


def test_a_skewed_table_is_hardly_read():
    """Where vectors' lengths differ, as those of popular items do, a few entries of each list decide."""
    rng = np.random.default_rng(1)
    v = np.round(np.abs(rng.normal(size=(4096, 16))) * 256 * (rng.random((4096, 1)) ** 8 * 20 + 0.05)).astype(int)
    asked = np.round(np.abs(rng.normal(size=(200, 16))) * 256).astype(int)
    lists = exact_topk.Lists(np.arange(4096), v)
    found = lists.best(asked, np.full(200, -1), 5)
    for q, (ids, scores) in zip(asked, found, strict=True):
        want, best = plain(np.arange(4096), v, q, -1, 5)
        assert ids.tolist() == want.tolist() and scores.tolist() == best.tolist()
    assert lists.read[0] < 0.15 * lists.read[1]
    assert lists.bounded <= 3 * 200 * 4096  # bounds of all vectors at a few looks, not at each stretch


def test_dropped_vectors_are_bounded_no_more():
    rng = np.random.default_rng(2)
    v = np.round(rng.normal(size=(3000, 8)) * 100).astype(int)
    lists = exact_topk.Lists(np.arange(3000), v)
    lists.best(v[:50], np.arange(50), 5)
    assert lists.bounded < 8 * 50 * 3000 and lists.read[0] < 0.5 * lists.read[1]
