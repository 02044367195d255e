"""The forest's kernels against full comparison, and its recall when trees are deep."""

import numpy as np
import pytest

llm = pytest.importorskip("loomspark.llm")
from loomspark.llm import rpforest  # noqa: E402
from tests.llm.test_models_and_duplicates import roots  # noqa: E402


@pytest.mark.parametrize("seed", range(12))
def test_kernels(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(rpforest, "STRIP", int(rng.integers(2, 40)))
    k, n = int(rng.integers(3, 9)), int(rng.integers(2, 300))
    x = rpforest._unit(rng.standard_normal((6, k))[rng.integers(0, 6, n)] + rng.standard_normal((n, k)) * 0.15)
    weight = rng.integers(1, 4, n)
    for first in (0, n // 2):
        linked = x @ x.T >= 0.98
        np.fill_diagonal(linked, False)
        if first:
            linked[:first, :first] = linked[first:, first:] = False
        assert (rpforest.counted(x, weight, 0.98, first) == linked @ weight).all()
        held = rpforest.held_together(x, 0.98, first)
        assert all(linked[a, b] for a, b in held) and len(held) < n
        assert roots(range(n), held) == roots(range(n), np.argwhere(linked).tolist())


def test_recall_of_deep_trees():
    """Pairs just above the threshold, 200,000 vectors, ten levels (the sample fits eight): nearly all share a leaf."""
    rng = np.random.default_rng(0)
    n = 100_000
    x = rpforest._unit(rng.standard_normal((n, 64)))
    d = rng.standard_normal((n, 64))
    y = 0.9802 * x + np.sqrt(1 - 0.9802**2) * rpforest._unit(d - (d * x).sum(1, keepdims=True) * x)
    both = np.concatenate([x, y])
    for leaf, most in ((rpforest.LEAF, 5), (256, 9)):
        forest = rpforest.Forest(both[rng.permutation(2 * n)[: rpforest.SAMPLE]], 2 * n, leaf=leaf, spill=rpforest.SPILL * 0.2)
        keys = [set(zip(*(a.tolist() for a in forest.leaves(v)), strict=True)) for v in (x, y)]
        assert len({i for i, _ in keys[0] & keys[1]}) >= 0.99 * n
        assert len(keys[0]) <= most * n


def test_huge_components(spark):
    rows = [(1, [1e308, 1e308], 0), (2, [9.9e307, 1e308], 0), (3, [1e-300, 1e-300], 0), (4, [1.0, -1.0], 0)]
    out = {r.vec_id: (r.n_links, r.component_id) for r in rpforest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert out == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}
