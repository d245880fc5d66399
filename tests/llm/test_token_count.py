from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulso.llm import token_count as tc
from pulso.llm.registry import op12_token_count

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["'", "s", "t", "re", "ve", "ll", "l", "r", "v", "e", "d", "m", "'S", "’", " ", "  ", "\n", "\t", "\r\n", "\x85", "\x1c", "　", "​", " ",
          "a", "b", "é", "é", "ß", "日", "本", "1", "2", "٣", "½", "Ⅷ", "ª", "!", "--", "=", "😀", "İ", "Ã", "ÃÂ" * 9, "x" * 50, " " * 40, "-" * 70, "ab" * 40,
          "<|endoftext|>", "<|endof", "text|>"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(tc.Vocabulary(open(PATH, encoding="utf-8").read()))


@pytest.fixture(scope="module")
def classes():
    return tc.character_classes()


def _texts(n, seed):
    rng = random.Random(seed)
    mixed = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    any_char = ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(n // 2)]
    return ["", " ", "\n", "'", "'r", "x 'll", *mixed, *any_char, *["".join(rng.choice("aeioustrn") for _ in range(300)) for _ in range(20)]]


def test_equals_the_library(counter, classes, library):
    texts = _texts(2000, 12)
    assert tc.count_tokens([t.encode() for t in texts], counter, classes).tolist() == library(texts)


def test_small_slabs_and_chunks_carry_their_states(counter, classes, library, monkeypatch):
    texts = _texts(100, 13) + ["'re" * 100, "a" * 3000, " " * 999, "<|endoftext|>" * 9, "é" * 500]
    for slab, chunk in ((13, 3), (64, 7), (1000, 256)):
        monkeypatch.setattr(tc, "SLAB", slab)
        monkeypatch.setattr(tc, "CHUNK", chunk)
        assert tc.count_tokens([t.encode() for t in texts], counter, classes).tolist() == library(texts)


def test_full_table_starts_anew(counter, classes, library, monkeypatch):
    monkeypatch.setattr(tc, "TRANSITIONS", 50)
    texts = _texts(100, 14)
    monkeypatch.setattr(tc, "SLAB", 100)
    assert tc.count_tokens([t.encode() for t in texts], counter, classes).tolist() == library(texts)


def test_cutter_equals_the_pattern_and_chunk_maps_compose(classes, monkeypatch):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in _texts(300, 15):
        codes = classes[np.array([*map(ord, text), 0x110000])]
        want = {m.start() for m in pattern.finditer(text)}
        for chunk in (1, 2, 5, 256):
            monkeypatch.setattr(tc, "CHUNK", chunk)
            marks, state = tc.piece_starts(codes, tc.CLOSED)
            assert set(np.flatnonzero(marks & tc.HERE)) | set(np.flatnonzero(marks & tc.BEFORE) - 1) == want
            assert state == tc.CLOSED


def test_every_code_point_has_the_librarys_class(counter, classes, library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in codes[i:i + 500]) for i in range(0, len(codes), 500)]
    assert tc.count_tokens([t.encode() for t in texts], counter, classes).tolist() == library(texts)


def test_neighbours_that_may_stand_together(counter):
    v = counter.vocabulary
    rng = random.Random(16)
    ids = [i for i in v.token if i >= 0]
    names = {}
    todo = [(0, b"")]
    children = {}
    for key, child in v.child.items():
        children.setdefault(key >> 8, []).append((key & 255, child))
    while todo:
        node, raw = todo.pop()
        names[v.token[node]] = raw
        todo += [(child, raw + bytes([b])) for b, child in children.get(node, [])]

    def encode(raw):     # merges of lowest rank first
        parts = [byte[b] for b in raw]
        while True:
            best = min(((v.merge[p][0], p) for p in zip(parts, parts[1:]) if p in v.merge), default=None)
            if best is None:
                return parts
            out, i = [], 0
            while i < len(parts):
                both = tuple(parts[i:i + 2]) == best[1]
                out.append(v.merge[best[1]][1] if both else parts[i])
                i += 1 + both
            parts = out

    byte = {n[0]: i for i, n in names.items() if len(n) == 1}
    for _ in range(5000):
        a, b = rng.choice(ids[:4000]), rng.choice(ids)
        assert v.follows(a, b) == (encode(names[a] + names[b]) == [a, b])


def test_query_on_the_given_texts(spark, library):
    rows = op12_token_count(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)


def test_nulls_repeats_clashing_columns_and_empty_table(spark, docs_of, library):
    texts = [None, "", "It's twice", "It's twice", "word " * 200000, "q" * 100000]
    df = docs_of(list(enumerate(texts)), extra="n_tokens long, count long, texts string")
    got = df.withColumn("out", tc.n_tokens(spark, "text", PATH))
    assert [r["out"] for r in got.orderBy("doc_id").collect()] == library([t or "" for t in texts])
    assert df.limit(0).select(tc.n_tokens(spark, F.col("text"), PATH)).collect() == []


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        tc.Vocabulary(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
