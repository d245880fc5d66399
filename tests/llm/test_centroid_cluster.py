from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from pulso.llm import centroid_cluster as cc

LONG = 2**63 - 1


def _near(v, centroids):
    return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))


def _brute(rows, k, rounds, dim, scale):
    kept = [(i, [max(-LONG - 1, min(LONG, math.floor(scale * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=name)[:k]]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(_near(v, centroids)[1], []).append(v)
        centroids = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else old for c, old in enumerate(centroids)]
    placed = [(i, *_near(v, centroids)[::-1]) for i, v in kept]
    of = {c: min(sum(min(d, LONG) for _, x, d in placed if x == c), LONG) for _, c, _ in placed}
    total = min(sum(min(d, LONG) for _, _, d in placed), LONG)
    return sorted(((i, c, min(d, LONG), of[c], total, tuple(centroids[c])) for i, c, d in placed), key=str)


def _got(df):
    return sorted(((*r[:5], tuple(r["centroid"])) for r in df.collect()), key=str)


def _rows(dim, n=200, spread=0.2):
    rng = random.Random(11)
    middles = [[rng.gauss(0, 0.3) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, spread) for x in middles[i % 6]]) for i in range(n)]
    rows += [(i, rows[3][1]) for i in range(n, n + 100)]             # a third of the rows are one vector
    rows += [rows[5], rows[5], (5, rows[9][1]), (None, rows[2][1])]  # repeated row, repeated id, no id
    return rows + [(900, None), (901, rows[0][1][:-1]), (902, rows[0][1] + [0.5]), (903, [None] + rows[0][1][1:]),
                   (904, [math.nan] * dim), (905, [math.inf] * dim), (906, [])]


def test_matches_brute_force(spark):
    rows = _rows(8)
    df = spark.createDataFrame([(i, v, 0, 0.0, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v double, centroid string")
    for k, rounds in ((8, 10), (7, 3), (1, 2)):
        assert _got(cc.cluster(df, k, rounds, dim=8)) == _brute(rows, k, rounds, 8, 1024)


def test_few_vectors_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, [-0.001, 0.0])]
    assert _got(cc.cluster(spark.createDataFrame(rows, schema), dim=2)) == _brute(rows, 8, 10, 2, 1024)
    assert _got(cc.cluster(spark.createDataFrame([], schema), dim=2)) == []
    assert _got(cc.cluster(spark.createDataFrame([(1, None)], schema), dim=2)) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randint(-20, e) * rng.random() for _ in range(4)]) for e in (30, 52) for i in range(60)]
    rows += [(99, [1e300, -1e300, 0.0, 1.0]), (98, [2.0**63, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _got(cc.cluster(df, 5, 4, dim=4)) == _brute(rows, 5, 4, 4, 1024)


def test_tournament_equals_all_distances():
    rng = np.random.default_rng(3)
    for k in (1, 2, 3, 5, 8, 13):
        centroids = rng.integers(-3, 4, (k, 3)).tolist()      # many ties and equal centroids
        x = rng.integers(-4, 5, (300, 3))
        near, distance = cc.Planes.of(centroids).nearest(x)
        assert [(int(d), int(c)) for c, d in zip(near, distance)] == [_near(v, centroids) for v in x.tolist()]
