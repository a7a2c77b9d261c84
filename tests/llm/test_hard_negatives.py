from __future__ import annotations

import math

import numpy as np
import pytest

from meterline.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<float>, q string, dim int, norm double"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA)


def plain(rows, every=100, positives=5, negatives=10):
    good = []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        good.append((i, label, [math.floor(256 * float(np.float32(v))) for v in x]))
    score = lambda a, b: sum(p * q for p, q in zip(a, b, strict=True))
    best, out = {}, []
    for i, label, q in good:
        if i % every == 0:
            same = [(-score(q, r), j) for j, other, r in good if j != i and other == label and len(r) == len(q)]
            best.setdefault(i, []).extend(same)
    windows = {}
    for i in best:
        for s, j in sorted(best[i])[:positives]:
            for k, label, q in good:
                if k == i:
                    wanted = [(-score(q, r), n, -s) for n, other, r in good if n != i and other != label and len(r) == len(q)]
                    windows.setdefault((i, j), []).extend(w for w in wanted if 30 * w[2] <= 100 * -w[0] <= 90 * w[2])
    for (i, j), wanted in windows.items():
        out += [(i, j, rank + 1, n, s, -v) for rank, (v, n, s) in enumerate(sorted(wanted)[:negatives])]
    return sorted(out)


def ours(spark, rows, **settings):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, hn.mine(made(spark, rows), **settings).select(*columns).collect()))


def clustered(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, int(rng.integers(4)), (centres[rng.integers(6)] + spread * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize(("spread", "dim"), [(0.05, 8), (0.5, 3), (2.0, 16), (0.3, 1)])
def test_every_pair_is_like_brute_force(spark, spread, dim):
    rows = clustered(1, 700, dim, spread)
    assert ours(spark, rows, every=20) == plain(rows, every=20)


def test_many_blocks_and_anchor_blocks(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 64)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    rows = clustered(2, 500, 6, 0.4)
    assert ours(spark, rows, every=10) == plain(rows, every=10)


def test_ties_and_a_hot_vector(spark):
    same = [0.5, 0.25, -0.125]
    rows = [(i, i % 3, same if i % 4 else [0.5, 0.1, 0.0]) for i in range(300)]
    assert ours(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (100, 1, [0.0, 0.0]), (200, None, [1.0, 1.0]), (300, 2, None), (400, 2, [1.0, None]), (500, 1, [nan, 1.0]), (600, 1, [1.0, -inf]),
        (None, 1, [1.0, 1.0]), (700, 1, []), (800, 2, []), (1, 1, [1.0, 0.4]), (2, 2, [0.5, 0.2]), (3, 2, [0.4, 0.2, 0.1]), (4, 1, [-1.0, -1.0]),
        (5, 2, [0.0, 0.0]), (900, 3, [1.0, 0.0]), (900, 3, [1.0, 0.0]), (6, 3, [0.9, 0.1]), (6, 3, [0.9, 0.1]), (7, 2, [1e-30, -1e-30]),
    ]
    assert ours(spark, rows) == plain(rows)
    assert hn.mine(made(spark, [])).collect() == []


def test_scores_beyond_double_precision(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (rng.normal(size=4) * 3e5).astype(np.float32).tolist()) for i in range(120)]
    assert ours(spark, rows, every=10) == plain(rows, every=10)
    huge = [(i, i % 2, [1e30 * (1 + i % 5), 1.0]) for i in range(0, 200, 20)]
    assert len(ours(spark, huge)) == len(plain(huge))


def test_labels_move(spark):
    rows = made(spark, [(7, 9, [1.0]), (14, None, [1.0]), (8, 9, [1.0])])
    assert [(r.vec_id, r.label) for r in hn.relabelled(rows).orderBy("vec_id").collect()] == [(7, 0), (8, 9), (14, None)]


def test_bounds_hold_every_score_and_leave_rows_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    x = np.floor(256 * (centres[rng.integers(5, size=400)] + 0.05 * rng.normal(size=(400, 12))))
    unit, norm = hn._unit(x)
    angles = np.arccos(np.clip(unit @ unit[:8].T, -1, 1))
    block = object.__new__(hn.Block)
    block.q, block.norm, block.angles = x, norm, angles.T
    tight = 0
    for a in range(60):
        low, high = block.bounds(angles[a], norm[a])
        scores = x @ x[a]
        assert (low <= scores).all() and (scores <= high).all()
        tight += int((high < 0.5 * scores.max()).sum())
    assert tight > 1000  # the filter does leave rows out
