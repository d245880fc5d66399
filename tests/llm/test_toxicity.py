from __future__ import annotations

import numpy as np

from pulso.llm import registry, toxicity as tx


def test_held_out_labels(spark):
    got = registry.op4_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    caught = sum(r["predicted"] for r in rows if r["toxic"] == 1)
    wrong = sum(r["predicted"] for r in rows if r["toxic"] == 0)
    # A few labels of either class have no toxic word at all.
    assert caught >= 0.85 * sum(r["toxic"] for r in rows)
    assert wrong <= 0.01 * sum(1 - r["toxic"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def _texts(rng, terms, n):
    common = ["the", "a", "of", "house", "river", "walks", "green"]
    return [" ".join([*rng.choice(common, 12), *terms, *rng.choice(common, 8)]).encode() for _ in range(n)]


def test_pairs_count_that_single_terms_do_not():
    """Neither the insult nor the group mention is toxic alone; only both together are."""
    rng = np.random.default_rng(3)
    texts = (_texts(rng, ["zorp"], 150) + _texts(rng, ["glim"], 150) + _texts(rng, [], 150) + _texts(rng, ["zorp", "glim"], 150))
    label = np.array([0] * 450 + [1] * 150)
    model = tx.train([tx.buckets(t) for t in texts], label)

    def score(terms):
        rows, begin = tx._rows(model.slot, [tx.buckets(t) for t in _texts(rng, terms, 20)])
        return tx._sigmoid(tx._raw(model, rows, begin)[0]).mean()

    assert score(["zorp", "glim"]) > 0.7 > 0.5 > max(score(["zorp"]), score(["glim"]), score([]))


def test_machine_output_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    model = tx.Model(np.full(1 << tx.HASH_BITS, -1, np.int32), 0.3, np.append(rng.normal(size=5), 0), np.vstack([rng.normal(size=(5, tx.FACTORS)), np.zeros((1, tx.FACTORS))]))
    model.slot[:5] = range(5)
    for chosen in ([], [2], [0, 1, 4], [0, 1, 2, 3, 4]):
        rows, begin = tx._rows(model.slot, [np.array(chosen, np.int32)])
        want = 0.3 + sum(model.w[i] for i in chosen) + sum(model.v[i] @ model.v[j] for i in chosen for j in chosen if i < j)
        assert np.isclose(tx._raw(model, rows, begin)[0][0], want)


def test_all_cases(spark, docs_of):
    texts = ["you are a zorp", "green river house"] * 30 + [None, "", "zorp " * 50000]
    docs = docs_of(list(enumerate(texts)) + [(0, texts[0]), (None, texts[1])])
    labels = spark.createDataFrame([(i, 1 - i % 2, None) for i in range(60)] + [(0, 1, None), (0, 0, None), (None, 1, None), (5, None, None)], "doc_id long, toxic int, text string")
    out = [(r["doc_id"], r["p"]) for r in docs.withColumn("p", tx.predict(docs, tx.fit(docs, labels))).collect()]
    assert len(out) == 65
    score = dict(out)
    assert score[0] > 0.7 > score[1] and score[62] > 0.7 and score[60] == score[61] < 0.7
    assert len({p for i, p in out if i == 0}) == 1


def test_missing_classes_and_empty_tables(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "b")])
    for rows, want in (([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert all(abs(r["p"] - want) < 1e-6 for r in docs.withColumn("p", tx.predict(docs, tx.fit(docs, labels))).collect())
    none = docs.limit(0)
    assert none.withColumn("p", tx.predict(none, tx.fit(none, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")))).collect() == []


def test_pairs_of_terms_as_frequent_in_either_class():
    """Toxic texts hold both terms or neither, clean ones exactly one: alone, neither term says anything."""
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(3000)]

    def texts(terms, n):
        return [tx.buckets(" ".join([*rng.choice(words, 60), *terms]).encode()) for _ in range(n)]

    model = tx.train(texts(["zorp"], 400) + texts(["glim"], 400) + texts([], 400) + texts(["zorp", "glim"], 400), np.array([0] * 800 + [1] * 800))

    def score(terms):
        return tx._sigmoid(tx._raw(model, *tx._rows(model.slot, texts(terms, 50)))[0]).mean()

    assert min(score(["zorp", "glim"]), score([])) > 0.5 > max(score(["zorp"]), score(["glim"]))


def test_unseen_texts_stop_the_wide_passes():
    """Chance differences of many rare words are not learned."""
    rng = np.random.default_rng(6)
    found = [np.unique(rng.integers(0, 1 << tx.HASH_BITS, 80).astype(np.int32)) for _ in range(400)]
    model = tx.train(found, np.arange(400) % 2)
    assert len(model.w) - 1 <= 5
