from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from pulso.llm import topk_search as ts


def _brute(rows, k, is_query):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    out = set()
    for q in filter(is_query, vectors):
        best = {}
        for a in vectors[q]:
            for i, vs in vectors.items():
                for b in vs:
                    if i != q and len(a) == len(b):
                        s = sum(x * y for x, y in zip(a, b))
                        best[i] = max(best.get(i, s), s)
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((q, rank, i, s))
    return out


def _rows():
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 320)]          # ties
    rows += [rows[50], rows[50], (51, rows[3][1])]              # repeated row, repeated id
    rows += [(400, None), (401, [0.1, None]), (402, [float("nan")] * 12), (403, [float("inf")] * 12), (None, rows[0][1]), (404, []),
             (450, [0.5, -0.5]), (451, [0.25, 0.25]), (500, [1.0] * 3), (501, [-0.001] * 12)]
    return rows


def test_matches_brute_force(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, score int, chunk int")
    want = _brute(rows, 5, lambda i: i % 50 == 0)
    assert {tuple(r) for r in ts.topk(df, F.col("vec_id") % 50 == 0).collect()} == want
    monkeypatch.setattr(ts, "CHUNK_ROWS", 40)
    monkeypatch.setattr(ts, "QUERY_ROWS", 3)
    assert {tuple(r) for r in ts.topk(df, F.col("vec_id") % 50 == 0).collect()} == want
    assert {tuple(r) for r in ts.topk(df.limit(0), F.col("vec_id") % 50 == 0).collect()} == set()


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(9)
    for dim in (1, 2, 3, 7, 64):
        x, q = rng.integers(-300, 300, (50, dim)).astype(float), rng.integers(-300, 300, (5, dim)).astype(float)
        exact, last = q @ x.T, np.full((5, 50), np.inf)
        for a, b in zip(ts.segment_levels(x), ts.segment_levels(q)):
            bound = b @ a.T
            assert (bound >= exact - 1e-6).all()
            if dim & (dim - 1) == 0:    # halves of halves: each level refines the one before
                assert (bound <= last + 1e-6).all()
            last = bound


def test_large_components_stay_exact():
    big = np.array([[2**30, -(2**30) + 1], [1, 2]], np.int64)
    assert ts._exact(big, np.array([2**30 + 3, 5], np.int64)).tolist() == [int(2**30) * (2**30 + 3) + 5 * (-(2**30) + 1), 2**30 + 13]
