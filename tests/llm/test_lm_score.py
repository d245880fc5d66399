from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from pulso.llm import lm_score as lm
from pulso.llm import registry


def _tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def _brute(rows, order, mu):
    """Counts in dictionaries and the smoothed probability by its recursion."""
    counts = [Counter() for _ in range(order + 1)]
    for i, t in rows:
        if not _held(i):
            seq = ["\n", *_tokens(t)]
            for k in range(1, order + 1):
                counts[k].update(tuple(seq[e - k + 1:e + 1]) for e in range(1, len(seq)) if e - k + 1 >= 0)
    n, v = sum(counts[1].values()), len(counts[1])
    uni = lambda w: (counts[1][(w,)] + 1) / (n + v + 1)

    def prob(gram):
        if len(gram) == 1:
            return uni(gram[0])
        below, c = prob(gram[1:]), counts[len(gram) - 1][gram[:-1]]
        return (counts[len(gram)][gram] + mu * below) / (c + mu) if c else below

    out = []
    for i, t in rows:
        seq = ["\n", *_tokens(t)]
        out.append((i, _held(i), len(seq) - 1, sum(counts[1][(w,)] > 0 for w in seq[1:]), n, sum(math.log10(uni(w)) for w in seq[1:]),
                    sum(math.log10(prob(tuple(seq[max(0, e - order + 1):e + 1]))) for e in range(1, len(seq)))))
    return out


def _texts():
    rng = random.Random(6)
    words = ["a", "B", "b", "été", "ÉTÉ", "\x1cx", "n b", "w" * 40]
    return [None, "", " \n ", "a", "A a\tb\x0bb"] + [rng.choice(["", " "]) + rng.choice([" ", "\n", "  "]).join(
        rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(60)]


def _same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g[:5]) == tuple(w[:5])
        assert math.isclose(g[5], w[5], rel_tol=1e-12) and math.isclose(g[6], w[6], rel_tol=1e-12)


def test_matches_brute_force(docs_of):
    rows = list(enumerate(_texts())) + [(3, "a"), (None, "a b")]
    for order, mu in ((1, 1.0), (2, 50.0), (3, 2.5)):
        got = lm.lm_score(docs_of(rows), order=order, mu=mu).collect()
        assert len(got) == len(rows)
        _same(got, _brute(rows, order, mu))


def test_blocks_and_slabs_do_not_change_tokens(monkeypatch):
    blob = [t.encode() for t in _texts() if t is not None]
    data, lens = np.frombuffer(b"".join(blob), np.uint8), np.array([len(b) for b in blob], np.int64)
    whole, per = lm.tokens(data, lens)
    assert per.tolist() == [len(_tokens(b.decode())) for b in blob]
    names = {}
    for t, h in zip([w for b in blob for w in _tokens(b.decode())], whole.tolist()):
        assert names.setdefault(t, h) == h
    assert len(set(names.values())) == len(names)
    monkeypatch.setattr(lm, "SLAB_BYTES", 16)   # below the longest word
    assert (lm.tokens(data, lens)[0] == whole).all()


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (lm._unpack_sorted(lm._pack_sorted(keys), len(keys)) == keys).all()
        assert (lm._unpack(lm._pack(keys), len(keys), np.uint64) == keys).all()


def test_states_sum_to_one():
    """Over all words and the unknown one, the arcs and the failure path of a state carry all mass."""
    rows = list(zip([i for i in range(20) if not _held(i)], ["a b a c", "a b b"]))
    vocabulary = ["a", "b", "c", "\n"]
    c1 = Counter(w for _, t in rows for w in _tokens(t))
    follow = Counter(p for _, t in rows for p in zip(["\n", *_tokens(t)], _tokens(t)))
    n, v = sum(c1.values()), len(c1)
    for h in vocabulary:
        total = 0.0
        for w in [*vocabulary, "unseen"]:
            counts = [np.array([c1[h], c1[w]]), np.array([0, follow[(h, w)]])]
            total += 10 ** lm.traverse(counts, np.array([0]), c1["\n"], n, v, 5.0)[1]
        assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_empty_table_and_no_training(docs_of):
    assert lm.lm_score(docs_of([])).collect() == []
    held = next(i for i in range(100) if _held(i))
    [row] = lm.lm_score(docs_of([(held, "a b")])).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def test_model_beats_base_on_held_out_texts(spark):
    rows = registry.op2_lm_score(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
