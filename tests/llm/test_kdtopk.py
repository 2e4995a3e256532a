import math

import numpy as np
import pytest

from quirework.llm.kdtopk import KDTree, Splits, bounds, exact, loose_bounds, top_k

LONG = 2**63 - 1


def brute(rows, k, every=20, scale=64.0):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("cells", [{}, {"shard_rows": 37, "block_rows": 5, "leaf": 4}, {"shard_rows": 20, "block_rows": 3, "leaf": 2, "max_cells": 4}])
def test_equal_to_brute_force(spark, cells):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=6) * 0.3, 1)]) for i in range(300)]
    rows += [(320, rows[0][1]), (340, [float("nan")] * 6), (360, None), (380, []), (400, [float("inf")] * 6), (420, [1.0, 2.0]), (421, [1.0, 2.0]), (None, [1.0] * 6)]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, dim int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(docs, 20, **cells).collect())
    assert got == brute([(i, None if v is None else [float(np.float32(x)) for x in v]) for i, v in rows], 20)


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [None])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(few).collect()] == [(0, 1, 1, 64 * 128)]
    assert top_k(few.where("vec_id > 5")).count() == 0


def saturated(rows):
    return [(q, r, i, max(-LONG - 1, min(LONG, x))) for q, r, i, x in rows]


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("size", [3e5, 1e8, 3e9, 1e17, 1e300])
def test_large_components_stay_exact(spark, size):
    rows = [(0, [size, 1.0]), (1, [size, 2.0]), (2, [size, 3.0]), (3, [-size, 5.0]), (4, [size / 2, 1.0]), (20, [1.0, 1.0]), (5, [2 * size, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = saturated(brute(rows, 4))
    for cells in ({}, {"shard_rows": 2, "block_rows": 1, "leaf": 1}):
        assert found(top_k(docs, 4, **cells)) == want


def test_far_components_rank_as_they_are(spark):
    rows = [(0, [1.0, 0.0]), (10, [300000.0, 1.0]), (20, [300000.0, 1.0]), (21, [600000.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(docs, 3)) == brute(rows, 3)


def test_beyond_double_takes_no_part(spark):
    docs = spark.createDataFrame([(0, [1.7e308]), (20, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in top_k(docs).collect()] == [(20, 1)]


def test_equal_vectors_and_repeated_rows(spark):
    rows = [(i, [1.0, 0.5]) for i in range(400)] + [(i, [0.25 * (i % 7), 1.0]) for i in range(400, 440)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(docs, 20, shard_rows=30, block_rows=4, leaf=8)) == brute(rows, 20)
    twice = docs.unionByName(docs.where("vec_id % 20 <> 0"))
    assert found(top_k(twice, 6, shard_rows=30, block_rows=4, leaf=8)) == brute(rows + [r for r in rows if r[0] % 20], 6)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(0, 9, (400, 3)) + c for c in ((0, 0, 0), (300, 0, 0), (0, 300, 300))]).astype(float)
    tree = KDTree(points, np.arange(len(points)), leaf=16)
    q = np.array([[5.0, 0.0, 0.0], [0.0, 1.0, -2.0]])
    bound = bounds(q, tree.lo, tree.hi)
    for leaf, rows in enumerate(tree.rows):
        assert len(rows) <= 16 and (q @ points[rows].T <= bound[:, leaf : leaf + 1] + 1e-9).all()
    assert (loose_bounds(q, tree.lo, tree.hi) >= bound).all()
    best, scored = tree.search(q, np.array([-1, -1]), 5, [None, None])
    assert scored < len(tree.rows)
    for j in range(2):
        want = sorted(((-int(s), i) for i, s in enumerate(points @ q[j])))[:5]
        mine = best.query == j
        assert sorted(zip((-best.score[mine]).tolist(), best.id[mine].tolist(), strict=True)) == want
    floor = int(sorted(points @ q[0])[-5])
    _, fewer = tree.search(q[:1], np.array([-1]), 5, [floor])
    _, more = tree.search(q[:1], np.array([-1]), 5, [None])
    assert fewer <= more


def test_far_cells_are_dropped():
    """Cells of clustered vectors whose bound is below the floor are never visited."""
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(256, 4)) + 50 * np.eye(4)[i % 4] * (1 + i // 4) for i in range(8)])
    splits = Splits(points, 8)
    cell = splits.cell_of(points)
    assert splits.cells == 8 and np.bincount(cell).max() <= 300
    lo, hi = (np.array([f(points[cell == c], axis=0) for c in range(8)]) for f in (np.min, np.max))
    q = points[:1]
    kth = np.sort(q @ points.T)[0, -20]
    assert (loose_bounds(q, lo, hi) < kth).sum() >= 3


def test_kinds_of_numbers():
    for top, kind in ((8.0, np.float64), (2.0**30, np.int64), (2.0**40, object)):
        p, q = exact(np.array([[top, 1.0]]), np.array([[top, -3.0]]))
        assert p.dtype == kind and int((p @ q.T)[0, 0]) == int(top) ** 2 - 3
