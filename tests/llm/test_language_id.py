from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from pulso.llm import language_id as li
from pulso.llm import registry


def test_held_out_accuracy(spark):
    got = registry.op1_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 7, 12, 30):
        code = li.codewords(n)
        assert len({tuple(c) for c in code}) == n
        assert all(0 < (code[:, b] > 0).sum() < n for b in range(code.shape[1]))
        apart = min((code[a] != code[b]).sum() for a, b in combinations(range(n), 2))
        assert apart >= 1 if n == 2 else apart >= 2 if n == 3 else apart >= 4
    assert li.codewords(1).shape == (1, 0) and li.codewords(0).shape == (0, 0)


def test_an_erring_classifier_is_corrected():
    """Any single bit may be wrong: the nearest codeword of 4 languages stays the right one."""
    code = li.codewords(4)
    bits = code.shape[1]
    model = li.Model(list("abcd"), code, np.zeros((li.BUCKETS + 1, bits)), np.zeros(bits), np.ones(bits), np.full(code.shape, 1 / bits))
    for k in range(4):
        for b in range(bits):
            margin = code[k].astype(float)
            margin[b] *= -1
            best, score, lead = li.decode(model, margin[None, :])
            assert best[0] == k and lead[0] > 0


def test_grams_do_not_depend_on_slabs(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["", "a", "ab", "abc", None] + ["".join(rng.choice(list("abcdé  .X"), rng.integers(1, 200))).lower() for _ in range(50)]
    weights = rng.normal(size=(li.BUCKETS + 1, 3)).astype(np.float32)
    weights[-1] = 0
    whole = li._margins(pa.array(texts), weights)
    for limit in (4, 17, 100):
        monkeypatch.setattr(li, "SLAB_BYTES", limit)
        assert np.allclose(li._margins(pa.array(texts), weights), whole, atol=1e-5)
    one_by_one = np.array([li._margins(pa.array([t], pa.string()), weights)[0] for t in texts])
    assert np.allclose(one_by_one, whole, atol=1e-5)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, t, g, None, i) for i, (t, g) in enumerate(
        [("the cat and the dog and the house", "en"), ("der hund und die katze und das haus", "de")] * 20
        + [(None, "en"), ("", "de"), ("12 34 !", "en"), ("the and the", None), ("the dog and the " * 20000, "en")])]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, found string, score long")


def test_all_cases(rows):
    model = li.fit(rows)
    assert model.languages == ["de", "en"]
    out = {r["doc_id"]: r["p"] for r in rows.withColumn("p", li.predict(rows, model)).collect()}
    assert len(out) == 45
    assert all(out[i]["lang"] == ("en", "de")[i % 2] for i in range(40))
    assert [out[i]["lang"] for i in (40, 41, 42, 43, 44)] == ["und", "und", "und", "en", "en"]
    assert all(out[i]["score"] == 0 and out[i]["ambiguous"] for i in (40, 41, 42))


def test_one_or_no_language(rows):
    one = li.fit(rows.filter("lang = 'en'"))
    assert {(r["p"]["lang"], r["p"]["score"]) for r in rows.withColumn("p", li.predict(rows, one)).collect()} == {("en", 1.0), ("und", 0.0)}
    none = li.fit(rows.limit(0))
    assert {r["p"]["lang"] for r in rows.withColumn("p", li.predict(rows, none)).collect()} == {"und"}
    assert rows.limit(0).withColumn("p", li.predict(rows.limit(0), one)).collect() == []
