from __future__ import annotations

import random
import re

from pulso.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _brute(text, items, window=10):
    words, hit, owners = _words(text), set(), set()
    for name, t in items:
        item = _words(t)
        k = min(window, len(item))
        for a in range(len(item) - k + 1 if k else 0):
            for i in range(len(words) - k + 1):
                if words[i:i + k] == item[a:a + k]:
                    hit |= set(range(i, i + k))
                    if name is not None:
                        owners.add(str(name))
    return len(words), len(hit), sorted(owners), hit


def test_automaton_matches_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        window = rng.choice([2, 3, 4])
        vocabulary = ["a", "B", "É", "c1"]
        items = [(str(k), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 8)))) for k in range(rng.randint(0, 4))]
        text = ", ".join(rng.choice([*vocabulary, "zz"]) for _ in range(rng.randint(0, 25)))
        automaton = dc.SuffixAutomaton([(k, dc.WORD.findall(t.encode().lower())) for k, t in items], window)
        codes = automaton.codes(text.encode().lower())
        ranges, owners = automaton.hits(codes)
        spans = dc._merge(ranges)
        assert (len(codes), sum(b - a + 1 for a, b in spans), sorted(owners)) == _brute(text, items, window)[:3]
        for s in dc._places(text.encode().lower(), spans):
            assert len(_words(text[s["start"]:s["end"]])) == s["last"] - s["first"] + 1


def test_long_texts_in_chunks(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice(["ab", "é", "xyz", "q"]) for _ in range(3000)).encode()
    automaton = dc.SuffixAutomaton([("1", [b"ab", "é".encode(), b"q"])])
    whole = automaton.codes(text).tolist()
    monkeypatch.setattr(dc, "CHUNK_BYTES", 5)
    assert automaton.codes(text).tolist() == whole


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again, 42 times."), (2, "short item"), (2, "Short item"), (10, None), (11, "... !"),
         (None, "nobody owns these exact ten words in this very item"), (3, "the lazy dog again and again, 42 times. Then it sleeps")]
TEXTS = [None, "", "?!", "clean text", "A SHORT  item.", "x the quick brown fox jumps over the lazy dog again y",
         "the quick brown fox jumps over the lazy dog", "É the quick brown fox jumps over the lazy dog again and again 42 times then it sleeps é",
         "nobody owns these exact ten words in this very item", "short item short item", "short short item item", "word " * 3000 + "short item"]


def test_annotate_in_one_and_many_blocks(spark, docs_of):
    docs = docs_of(list(enumerate(TEXTS)) + [(4, TEXTS[4])])
    bench = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    for block_words in (200_000, 8):
        rows = dc.annotate(docs, bench, out="__f", block_words=block_words).collect()
        assert len(rows) == len(TEXTS) + 1
        for r in rows:
            assert (r["__f"]["n_words"], r["__f"]["n_hit"], r["__f"]["items"]) == _brute(r["text"], ITEMS)[:3], r["text"]


def test_remove(spark, docs_of):
    docs = docs_of(list(enumerate(TEXTS)))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = {r["doc_id"]: r["text"] for r in dc.remove(docs, bench, max_share=0.95).collect()}
    assert out[0] is None and out[1] == "" and out[3] == "clean text"
    assert out[4] == "A ." and out[5] == "x  y" and out[7] == "É  é" and out[10] == "short  item"
    assert 8 not in out and 9 not in out
    assert out[11] == "word " * 3000


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r["f"]["n_hit"] for r in dc.annotate(docs_of([(1, "a b"), (2, None)]), bench, out="f").collect()] == [0, 0]
    assert dc.remove(docs_of([]), spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []


def test_copies_of_a_benchmark_row_are_dealt_once(spark):
    text = "one two three four five six seven eight nine ten eleven"
    rows = [("a", text)] * 50 + [("b", text), ("a", text + " twelve"), ("c", None), ("c", None)]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    assert len(dc._blocks(bench, "item_id", 10, 100)) == 1
    many = dc._blocks(bench, "item_id", 10, 20)
    dealt = [(r["item"], r["text"]) for b in many for r in b.collect()]
    assert len(many) == 2 and len(dealt) == len(set(dealt)) == 4
    docs = spark.createDataFrame([(1, "zero " + text), (2, "nothing")], "doc_id long, text string")
    hit = {r["doc_id"]: r["found"] for r in dc.annotate(docs, bench, 10, block_words=20).collect()}
    assert (hit[1]["n_hit"], list(hit[1]["items"]), hit[2]["n_hit"]) == (11, ["a", "b"], 0)
