"""Passes over the blocks of one task: derivatives once a round, rows routed level by level."""

import numpy as np

from tabforge.operators import boosting as bo


def _block(n=900):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 12, (n, 3)).astype(np.uint16)
    y = (x[:, 0] + x[:, 1] + rng.normal(0, 3, n) > 11).astype(float)
    return x, y, np.arange(n) % 5 == 0, rng.integers(-2**62, 2**62, n), np.zeros(n)


def test_derivatives_are_made_once_a_round(monkeypatch):
    made, real = [], bo._derivatives
    monkeypatch.setattr(bo, "_derivatives", lambda *a: made.append(1) or real(*a))
    spec = bo.Spec("Classification", 3, 13, 12, 9, 0.3, 1.0, 0.8, 1, 0.0, 8, 4, 10, False)
    trees, _ = bo.boost(bo.InTask(spec, [_block(), _block(700)]), spec)
    assert len(trees) == 4 and len(made) == 2 * 4


def test_routes_and_margins_follow_the_splits():
    x, y, v, d, _ = _block()
    spec = bo.Spec("Classification", 3, 13, 12, 9, 0.3, 1.0, 1.0, 1, 0.0, 8, 1, 10, False)
    tree = bo.boost(bo.InTask(spec, [(x, y, v, d, np.zeros(900))]), spec)[0][0]
    margin = np.zeros(900)
    tree.add(margin, x)
    for row, leaf, m in zip(x, tree.route(x), margin):
        i = 1
        while i in tree.splits:
            i = 2 * i + int(row[tree.splits[i].feature] > tree.splits[i].bin)
        assert i == leaf and m == tree.nodes[i].value
