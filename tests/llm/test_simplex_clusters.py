from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martworks.llm import simplex_clusters as sc

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, centroids=16, rounds=3):
    """Rows (id, cluster, distance, cluster inertia, inertia, digest) by whole numbers of Python."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [max(-sc.LIMIT, min(sc.LIMIT, math.floor(64 * x))) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    at = [r[1] for r in order[:centroids]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(at)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for k in range(len(at)):
            mine = [v for (_, v), (_, n) in zip(kept, found) if n == k]
            if mine:
                at[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    out = []
    for (vec_id, _), (d, k) in zip(kept, found):
        digest = hashlib.sha256(",".join(map(str, at[k])).encode()).hexdigest()
        out.append((vec_id, k, d, sum(x for x, n in found if n == k), sum(x for x, _ in found), digest))
    return sorted(out, key=repr)


def actual(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    frame = frame.withColumns({c: F.lit("x") for c in ("_id", "_v", "_w", "_a", "cluster", "distance")})
    return sorted((tuple(r) for r in sc.cluster(frame, **options)[0].collect()), key=repr)


def vectors(n, seed=3):
    """Clumps of different sizes, in single precision, as the table has them."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.3, (9, 64))
    return (middles[rng.integers(0, 9, n)] + rng.normal(0, 0.05, (n, 64))).astype(np.float32).astype(float).tolist()


def test_awkward_vectors(spark):
    rows = list(enumerate(vectors(90)))
    rows += [(200, None), (201, []), (202, [0.5] * 63), (203, [0.5] * 65), (204, [None] + [0.5] * 63), (205, [float("nan")] + [0.5] * 63),
             (206, [float("inf")] + [0.5] * 63), (207, [-0.0] * 64), (208, [0.0] * 64), (None, [0.25] * 64), (None, [0.125] * 64),
             (3, rows[3][1]), (3, rows[4][1]), (209, [1e30] * 64), (210, [-1e30] * 64), (211, [-0.001] * 64)]
    rows += [(300 + i, rows[0][1]) for i in range(60)]
    assert actual(spark, rows) == expected(rows)


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [0.25] * 64)]
    assert actual(spark, rows) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0])]])
def test_no_vectors(spark, rows):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    found = sc.cluster(frame)[0]
    assert found.collect() == []
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_other_numbers(spark):
    rows = list(enumerate(vectors(120, 8)))
    assert actual(spark, rows, centroids=5, rounds=1, pivots=2) == expected(rows, 5, 1)
    assert actual(spark, rows, pivots=1) == expected(rows)


def test_bounds_hold_and_spare_work():
    whole = np.floor(np.array(vectors(3000, 4)) * 64).astype(np.int32)
    for pivots in (1, 2, 8, 16):
        simplex = sc.Simplex(whole[:16], pivots)
        assert len(simplex.pivots) <= pivots
        a, b = simplex.apexes(whole), simplex.apexes(whole[100:140])
        low, high = sc.bounds(a, b)
        true = np.sqrt(((whole[:, None].astype(np.int64) - whole[None, 100:140]) ** 2).sum(axis=2))
        assert (low <= true).all() and (true <= high).all()
    simplex = sc.Simplex(whole[:16], 8)
    _, _, exact = sc.nearest(whole, simplex.apexes(whole), whole[:16], simplex.apexes(whole[:16]))
    assert exact < 0.5 * 16 * len(whole)


def test_pivots_in_one_span_are_left_out():
    line = np.array([[i, 2 * i, 0] for i in range(6)], np.int32)
    assert len(sc.Simplex(line, 5).pivots) == 2
    assert len(sc.Simplex(line[[0, 0, 0]], 5).pivots) == 1
