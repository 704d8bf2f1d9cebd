import math

import numpy as np
import pytest

from tidemark.llm import topk


def brute(rows, k, every):
    usable = {(i, tuple(math.floor(64.0 * float(np.float32(x))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i in {i for i, _ in usable if i % every == 0}:
        for vector in {v for j, v in usable if j == i}:
            scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=False)), j) for j, v in usable if j != i)
            out += [(i, rank, j, -score) for rank, (score, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k, every):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, vec string, leaf string" if rows and len(rows[0]) == 5 else "vec_id long, embedding array<float>")
    return sorted(map(tuple, topk.top_k(frame, k, every).collect()))


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_clusters_copies_and_ties(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "GROUP", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    vectors = [(centres[i % 6] + spread * rng.normal(size=8)).tolist() for i in range(300)]
    vectors += [vectors[0]] * 120  # copies
    rows = [(i, v, 1, "x", "y") for i, v in enumerate(vectors)]
    rows += [(None, vectors[1], 1, "x", "y"), (9000, None, 1, "x", "y"), (9020, [float("nan")] * 8, 1, "x", "y"), (9040, [None] * 8, 1, "x", "y"),
             (9060, [float("inf")] * 8, 1, "x", "y"), (9080, [0.5] * 3, 1, "x", "y"), (9100, [], 1, "x", "y"), rows[0], rows[20]]
    assert found(spark, rows, 20, 20) == brute([(r[0], r[1]) for r in rows], 20, 20)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])]
    assert found(spark, rows, 20, 20) == brute(rows, 20, 20)
    assert found(spark, [(0, [1.0])], 20, 20) == []
    assert found(spark, [], 20, 20) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=4) * 1e6).tolist()) for i in range(60)]
    assert found(spark, rows, 5, 20) == brute(rows, 5, 20)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 6)) * 100
    points = np.concatenate([c + rng.normal(size=(80, 6)) for c in centres])
    tree = topk.grow(points)
    far = topk.distances(points, tree.centres)
    leaf = far[:, tree.levels[-1]].argmin(axis=1)
    steps = np.take_along_axis(far, tree.path()[leaf], axis=1)
    radii = {n: steps[leaf == n].max(axis=0).tolist() for n in set(leaf.tolist())}
    bounds = topk.Bounds(tree, radii, radii)
    products = points @ points.T
    last = len(tree.levels) - 1
    worst = {}
    for a in radii:
        kth = np.sort(products[leaf == a], axis=1)[:, -20]
        worst[a] = float(kth.min())
        for b in radii:
            top = bounds.bound(last, int(tree.path()[a, last]), last, int(tree.path()[b, last]))
            assert products[np.ix_(leaf == a, leaf == b)].max() <= top
    open_pairs = bounds.open_pairs(worst)
    for a in radii:
        for b in radii:
            if (products[np.ix_(leaf == a, leaf == b)] >= worst[a]).any():
                assert (a, b) in open_pairs
    assert len(open_pairs) < len(radii) ** 2 / 2
