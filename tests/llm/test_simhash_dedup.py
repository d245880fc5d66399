from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from pulso.llm import simhash_dedup as sd


def _brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _brute_roots(prints, radius=2):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


TEXTS = [None, "", " \n\t", "One", "one", "one two", "Été été", "ÉTÉ été", "a b c d e f g", "A B C  d e\nf g", "x " * 5000, "x " * 5001,
         "\x00a\x1c b c d"]


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    more = [" ".join(rng.choice("ab cd Ef gh É".split()) for _ in range(rng.randint(1, 40))) for _ in range(100)]
    for t in TEXTS + more:
        assert sd.fingerprint((t or "").encode()) == _brute_print(t)


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(str(k * k) for k in range(500)).encode()
    whole = sd.fingerprint(text)
    monkeypatch.setattr(sd, "HASH_CHUNK", 7)
    assert sd.fingerprint(text) == whole


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_connect_the_same_components_as_all_pairs(spark):
    rng = random.Random(2)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 15)):     # chains: each step is a link, ends are far apart
            prints.add(p)
            for _ in range(rng.randint(1, 3)):
                p ^= 1 << rng.randrange(64)
    df = spark.createDataFrame([(_signed(p),) for p in prints], "fp long")
    roots = {r["node"]: r["root"] for r in sd.components(sd.links(df)).collect()}
    want = _brute_roots(prints)
    groups = lambda f: sorted(sorted(g) for g in {k: [p for p in prints if f(p) == k] for k in {f(p) for p in prints}}.values())
    assert groups(lambda p: roots.get(_signed(p), _signed(p))) == groups(lambda p: want[p])


def test_large_tiles_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(sd, "TILE_ROWS", 4)
    near = [1 << a | 1 << b for a in range(16) for b in range(a)]   # one cell, every two at most 4 bits apart
    df = spark.createDataFrame([(p,) for p in near], "fp long")
    assert sd._tiles(df).count() > 10
    roots = sd.components(sd.links(df)).collect()
    assert len({r["root"] for r in roots}) == 1 and len(roots) == len(near) - 1


def test_long_chain_settles(spark):
    chain = [(i, i + 1) for i in range(400)]
    out = sd.components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert len(out) == 400 and {r["root"] for r in out} == {0}


def test_all_cases(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, "one"), (None, "one"), (None, "only without id")]
    got = sd.simhash_components(docs_of(rows)).collect()
    assert len(got) == len(rows)
    prints = {_brute_print(t) for _, t in rows}
    root = _brute_roots(prints)
    least = {}
    for i, t in rows:
        if i is not None:
            r = root[_brute_print(t)]
            least[r] = min(least.get(r, i), i)
    want = sorted((i if i is not None else -1, f"{_brute_print(t):016x}", least.get(root[_brute_print(t)], -1)) for i, t in rows)
    assert sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in got) == want


def test_keep_one(docs_of):
    rows = [(3, "a b c d"), (1, "A b C d"), (1, "A b C d"), (2, "completely other words here"), (None, "a b c d"), (7, None), (6, "")]
    out = sd.keep_one(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in out.collect() if r["doc_id"] != 6) == [(-1, "a b c d"), (1, "A b C d"), (2, "completely other words here")]
    assert [r["doc_id"] for r in out.collect()].count(6) == 1


def test_empty_table(docs_of):
    assert sd.simhash_components(docs_of([])).collect() == []
    assert sd.keep_one(docs_of([])).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_ball_covers_all_segment_differences(radius):
    rng = np.random.default_rng(radius)
    ball = set(sd._ball(radius))
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, radius, replace=False):
            b ^= 1 << int(bit)
        cell = lambda x: [(x >> 16 * s & 0xFFFF).bit_count() for s in range(4)]
        d = tuple(y - x for x, y in zip(cell(a), cell(b)))
        assert d in ball or tuple(-x for x in d) in ball
