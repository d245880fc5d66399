from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline as cp
from pulso.llm import language_id
from tests.llm.test_best_fit_packing import _brute as brute_bins
from tests.llm.test_decontaminate import WORD, _brute as brute_hits, _words
from tests.llm.test_secret_scan import _brute as brute_secrets
from tests.llm.test_simhash_dedup import _brute_print, _brute_roots

SF = "/root/testdata/sf0.001"


def _brute(docs, bench):
    """The rows after each stage after language identification, in plain Python."""
    prints = {i: _brute_print(t) for i, t, _ in docs}
    root = _brute_roots(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    kept = [(i, t, s) for i, t, s in docs if least[root[prints[i]]] == i]
    cut = []
    for i, t, s in kept:
        n, n_hit, _, hit = brute_hits(t, bench)
        if n_hit <= 0.5 * n:
            out, at, places = "", 0, list(WORD.finditer("".join(c.lower() if c.isascii() else c for c in t)))
            for k, m in enumerate(places):
                if k in hit and k - 1 not in hit:
                    out += t[at:m.start()]
                if k in hit:
                    at = m.end()
            cut.append((i, out + t[at:], s))
    clean = []
    for i, t, s in cut:
        out, reach = "", 0
        for a, _, b in brute_secrets(t):
            if a >= reach:
                out += t[reach:a] + "[secret]"
            reach = max(reach, b)
        clean.append((i, out + t[reach:], s))
    return kept, cut, clean


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, SF), "test-pipeline")
        out.append(docs)
    return out


def test_stages_match_brute_force(spark, stages):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = lambda df: sorted((r["doc_id"], r["text"], r["source"]) for r in df.collect())
    assert rows(stages[0]) == rows(source)      # every document there has a language
    for got, want in zip(stages[1:4], _brute(rows(source), bench)):
        assert got.columns == source.columns
        assert rows(got) == sorted(want)
        assert all(r["n_chars"] == len(r["text"]) for r in got.collect())
    sizes = {i: len(t.split()) + 1 for i, t, _ in rows(stages[3])}
    rest = sorted(((i, n % 2048, s) for (i, _, s), n in zip(rows(stages[3]), sizes.values())), key=lambda x: (-x[1], x[0]))
    rest = [x for x in rest if x[1]]
    bins = brute_bins([x[1] for x in rest], [x[2] for x in rest], [None] * len(rest), 2048)
    got = {r["doc_id"]: r["bin_id"] for r in stages[4].collect() if not r["bin_id"].startswith("full")}
    assert got == {x[0]: f"0-{b}" for x, b in zip(rest, bins)}


def test_run_returns_the_last_stage(spark, stages):
    key = lambda r: (r["bin_id"], r["slot"])
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))
    assert cp.ORACLE_SQL is None and [n for n, _ in cp.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "secret_scan", "best_fit_packing"]
    assert len({key(r) for r in stages[-1].collect()}) == stages[-1].count()


def _tables(tmp_path, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT, found VARCHAR, block INT)")
    if rows:
        con.executemany("INSERT INTO d VALUES (?, ?, ?, ?, ?, 'x', 1)", rows)
    con.execute(f"COPY d TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT 1::BIGINT AS item_id, 'alpha beta gamma delta' AS text, 7 AS n) TO '{tmp_path}/benchmark.parquet' (FORMAT parquet)")
    return str(tmp_path)


def test_awkward_rows(spark, tmp_path):
    en, de = "the cat and the dog and the house number {}", "der hund und die katze und das haus nummer {}"
    rows = [(i, (en, de)[i % 2].format(" ".join(f"{w}{i}" for w in "abcdef")), ("en", "de")[i % 2], f"s{i % 3}", 1) for i in range(40)]
    n = len(rows)
    rows += [(100, None, "en", "s", None), (101, "", None, "s", 0), (102, "123 ?!", "en", "s", 6), rows[0], rows[0], (103, rows[1][1].upper(), "de", None, 9),
             (104, "the dog said token=abcdefgh12345 and the cat and the house", "en", None, 1), (105, "alpha beta gamma delta", "en", "s", 5),
             (106, "the cat and the dog and alpha beta gamma delta and the house by the sea", "en", "s", 5), (None, "the cat and the bird and the garden", None, "s", 3),
             (107, "the sea and the " * 20000, "en", "s0", 1)]
    sf, got = _tables(tmp_path, rows), []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, sf), "test-pipeline")
        got.append(docs)
    ids = [sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in g.select("doc_id").collect()) for g in got]
    assert not {100, 101, 102} & set(ids[0]) and len(ids[0]) == len(rows) - 3
    assert 103 not in ids[1] and ids[1].count(0) == 1 and ids[1].count(-1) == 1
    assert 105 not in ids[2]
    text = {r["doc_id"]: r["text"] for r in got[3].collect()}
    assert text[104] == "the dog said [secret] and the cat and the house"
    assert text[106] == "the cat and the dog and  and the house by the sea"
    for i in range(1, n):
        assert text[i] == rows[i][1]
    words = defaultdict(int)
    for r in got[4].collect():
        words[r["doc_id"]] += r["n_tokens"]
    assert words == {i: len(t.split()) + 1 for i, t in text.items()}
    assert got[3].columns == spark.read.parquet(f"{sf}/documents.parquet").columns


def test_empty_documents(spark, tmp_path):
    assert cp.run(spark, _tables(tmp_path, [])).collect() == []


def test_language_stage_rejects_only_what_has_no_language(spark):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "de", "s", 0) for i, t in enumerate(["der hund und das haus", "the dog and the house"] * 30 + ["?", None, "the"])],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in cp.keep_known_languages(spark, docs, "").collect()}
    assert kept == {*range(60), 62}
    assert language_id.UNDETERMINED == "und"


def test_no_part_of_a_secret_beside_another_is_left(spark):
    """The assignment starts inside the high-entropy stretch; the key before it is masked too."""
    key = "aB3xK9qLm2Zr7TyW5pVd"
    docs = spark.createDataFrame([(1, f"see /{key}/token=abcd1234 here", None), (2, f"token={key} here", None)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in cp.mask_secrets(spark, docs, SF).collect()}
    assert key not in got[1] and "abcd1234" not in got[1] and got[1].endswith(" here") and got[2] == "[secret] here"


def test_columns_with_working_names_are_kept(spark):
    extra = ["__found", "__spans", "__cut", "__language", "__text", "row", "found", "language", "a.b"]
    text = "the dog said token=abcdefgh12345 and alpha beta gamma delta and the house"
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame([(i, text if i == 1 else f"the cat and the dog {i}", "en", "s", 9, *extra) for i in range(1, 4)], schema)
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    for out in (cp.keep_known_languages(spark, docs, ""), cp.decontaminate.remove(docs, bench, window=4), cp.mask_secrets(spark, docs, "")):
        assert out.columns == docs.columns
        rows = out.collect()
        assert len(rows) == 3 and all(tuple(r)[5:] == tuple(extra) for r in rows)
