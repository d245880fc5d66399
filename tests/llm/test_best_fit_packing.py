from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from pulso.llm import best_fit_packing as bp
from pulso.llm import registry


def _brute(sizes, sources, clusters, capacity):
    """Every bin is looked at for every piece."""
    left, has_s, has_c, out = [], [], [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(r, b) for b, r in enumerate(left) if r >= size and not (s is not None and s in has_s[b]) and not (c is not None and c in has_c[b])]
        if fits:
            b = min(fits)[1]
        else:
            b = len(left)
            left.append(capacity), has_s.append(set()), has_c.append(set())
        left[b] -= size
        has_s[b].add(s), has_c[b].add(c)
        out.append(b)
    return out


def test_search_finds_the_tightest_compatible_bin(monkeypatch):
    rng = random.Random(7)
    for run in (2, 3, 64):
        monkeypatch.setattr(bp, "RUN", run)
        for _ in range(120):
            n, capacity = rng.randint(0, 120), rng.choice([10, 50, 200])
            sizes = sorted((rng.randint(0, capacity) for _ in range(n)), reverse=rng.random() < 0.7)
            sources = [rng.choice(["hot", "hot", "hot", "a", "b", "c", None, f"s{rng.randint(0, 9)}"]) for _ in range(n)]
            clusters = [rng.choice([None, 1, 1, 2, rng.randint(3, 60)]) for _ in range(n)]
            assert bp.best_fit(sizes, sources, clusters, capacity) == _brute(sizes, sources, clusters, capacity)


def _packed(spark, rows, capacity=10):
    df = spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, n long, src string, c long, bin_id int, piece string")
    return bp.pack(df, F.col("n"), F.col("src"), F.col("c"), capacity).collect()


def test_all_cases(spark):
    big = 2**60 + 1
    rows = [(1, 35, "a", None), (2, 5, "a", big), (3, 5, "b", big), (4, 5, "b", big - 1), (5, 0, None, None), (6, None, None, None), (7, -3, "z", None),
            (8, 10, "a", None), (None, 4, "q", None), (9, 4, "hot", 5), (9, 4, "hot", 5), (9, 4, "hot", 5), (10, 20, None, None)]
    out = _packed(spark, rows)
    tokens = defaultdict(int)
    for r in out:
        tokens[r["doc_id"]] += r["n_tokens"]
    assert tokens == {1: 35, 2: 5, 3: 5, 4: 5, 5: 0, 6: 0, 7: 0, 8: 10, None: 4, 9: 12, 10: 20}
    assert sorted((r["start"], r["n_tokens"]) for r in out if r["doc_id"] == 1) == [(0, 10), (10, 10), (20, 10), (30, 5)]
    assert {r["copy"] for r in out if r["doc_id"] == 9} == {1, 2, 3} and len({r["bin_id"] for r in out if r["doc_id"] == 9}) == 3
    bins = defaultdict(list)
    for r in out:
        bins[r["bin_id"]].append(r)
    source = {r[0]: r[2] for r in rows}
    for parts in bins.values():
        assert sum(p["n_tokens"] for p in parts) <= 10
        assert sorted(p["slot"] for p in parts) == list(range(len(parts)))
        named = [source[p["doc_id"]] for p in parts if source[p["doc_id"]] is not None]
        assert len(named) == len(set(named))
        assert not {2, 3} <= {p["doc_id"] for p in parts}
    assert _packed(spark, []) == []


def test_query_packs_every_word(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = {r["doc_id"]: (r["n"], r["source"], r["same"]) for r in docs.select(
        "doc_id", "source", bp.words_and_end().alias("n"), bp.same_text().alias("same")).collect()}
    for r in docs.collect()[:100]:
        assert words[r["doc_id"]][0] == len((r["text"] or "").split()) + 1
    out = registry.op6_best_fit_packing(spark, sf).collect()
    total, bins = defaultdict(int), defaultdict(list)
    for r in out:
        total[r["doc_id"]] += r["n_tokens"]
        bins[r["bin_id"]].append(r)
    assert total == {k: v[0] for k, v in words.items()}
    for parts in bins.values():
        assert sum(p["n_tokens"] for p in parts) <= bp.CAPACITY
        for field in (1, 2):
            named = [words[p["doc_id"]][field] for p in parts if words[p["doc_id"]][field] is not None]
            assert len(named) == len(set(named))
    # All rows are one group here: the same bins as looking at every bin for every piece.
    rest = sorted((r for r in out if not r["bin_id"].startswith("full")), key=lambda r: (-r["n_tokens"], r["doc_id"]))
    want = _brute([r["n_tokens"] for r in rest], [words[r["doc_id"]][1] for r in rest], [words[r["doc_id"]][2] for r in rest], bp.CAPACITY)
    assert [r["bin_id"] for r in rest] == [f"0-{b}" for b in want]
