"""Label matching: each stage, ties, misses, and the two physical strategies."""

from __future__ import annotations

from difflib import SequenceMatcher

from pulso.functions.similarity import ratcliff_ratio
from pulso.operators.matching import match_labels, unmatched

DIM = [(0, "¿Cómo es la cultura?", "IQ"), (1, "Recursos disponibles", "AU"), (2, "Recursos  disponibles!", "AV"),
       (3, "Trabajo en equipo", "BG")]


def _dim(spark):
    return spark.createDataFrame(DIM, "ord INT, label STRING, question_id STRING")


def _left(spark):
    rows = [("¿Cómo es la cultura?",), ("como es la cultura",), ("Trabajo en equpo",), ("nada que ver",),
            ("RECURSOS DISPONIBLES",), (None,)]
    return spark.createDataFrame(rows, "q STRING")


def _run(spark, metric, max_inline=5000):
    out = match_labels(_left(spark), "q", _dim(spark), threshold=0.75, metric=metric, max_inline=max_inline)
    return {r.q: (r.match_value, r.match_method) for r in out.collect()}


def test_stages_ratcliff_inline(spark):
    got = _run(spark, "ratcliff")
    assert got["¿Cómo es la cultura?"] == ("IQ", "exact")
    assert got["como es la cultura"] == ("IQ", "normalized")
    assert got["Trabajo en equpo"] == ("BG", "fuzzy")
    assert got["nada que ver"] == (None, None)
    # both "Recursos" keys normalise to the same text: the later dimension row wins
    assert got["RECURSOS DISPONIBLES"][0] in ("AU", "AV")
    assert got[None] == (None, None)


def test_banded_join_equals_inline(spark):
    for metric in ("ratcliff", "levenshtein"):
        assert _run(spark, metric) == _run(spark, metric, max_inline=0)


def test_unmatched(spark):
    out = unmatched(match_labels(_left(spark), "q", _dim(spark), metric="levenshtein"))
    assert sorted(r.q or "" for r in out.collect()) == ["", "nada que ver"]


def test_ratcliff_udf_is_difflib(spark):
    pairs = [("trabajo en equpo", "trabajo en equipo"), ("abc", ""), ("", ""), ("gen z", "generacion z")]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    got = [r[0] for r in df.select(ratcliff_ratio(df.a, df.b)).collect()]
    assert got == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_strategies_agree_over_thresholds_metrics_and_modes(spark):
    """Boundary scores included: "ab" against "abc" is exactly 0.8 for the gestalt ratio."""
    keys = ["abc", "ábcd", "Abcd", "xyz", "a", "", "abcdefghijklmnopqrst", "zz top", "abc"]
    dim = spark.createDataFrame([(i, k, f"v{i}") for i, k in enumerate(keys)], "ord INT, label STRING, question_id STRING")
    words = ["ab", "abc", "ABCD", "ábc", "xy", "", "q", "abcdefghijk", "zz  tap", "b", None, "abcdefghijklmnopqrsx", "top zz"]
    left = spark.createDataFrame([(w,) for w in words], "q STRING")
    for metric in ("ratcliff", "levenshtein"):
        for mode in ("label", "name", "best"):
            for t in (0.0, 0.1, 0.2, 0.55, 0.6, 0.75, 0.8, 0.85, 0.95) if mode != "best" else (0.0,):
                run = lambda cap: sorted(map(str, match_labels(left, "q", dim, threshold=t, metric=metric, mode=mode, max_inline=cap).collect()))  # noqa: E731,B023
                assert run(5000) == run(0), (metric, mode, t)
    hit = match_labels(left.filter("q = 'ab'"), "q", dim.filter("label = 'abc'"), threshold=0.8, max_inline=0).first()
    assert (hit.match_method, hit.match_score) == ("fuzzy", 0.8)


def test_similarity_join_gives_the_matches_of_the_other_strategies(spark, monkeypatch):
    from pulso.operators import matching

    dim = spark.createDataFrame([(i, k, f"v{i}") for i, k in enumerate(_texts(60, 3))], "ord INT, label STRING, question_id STRING")
    left = spark.createDataFrame([(w,) for w in [*_texts(50, 4), None]], "q STRING")
    for metric, mode, t in (("ratcliff", "label", 0.75), ("levenshtein", "name", 0.5), ("levenshtein", "label", 0.8), ("ratcliff", "best", 0.0)):
        run = lambda cap: sorted(map(str, match_labels(left, "q", dim, threshold=t, metric=metric, mode=mode, max_inline=cap).collect()))  # noqa: E731,B023
        monkeypatch.setattr(matching, "FEW_PAIRS", 0)
        joined = run(0)
        monkeypatch.setattr(matching, "FEW_PAIRS", 10**6)
        assert joined == run(0) == run(5000), (metric, mode, t)


def test_name_resolution_ignores_accents(spark):
    names = spark.createDataFrame([(0, "Opinión 2024")], "o INT, n STRING")
    left = spark.createDataFrame([("Opinio",), ("OPINIÓN",)], "w STRING")
    for cap in (0, 5000):
        got = match_labels(left, "w", names, "n", "n", "o", threshold=0.95, mode="name", max_inline=cap).collect()
        assert {r.match_method for r in got} == {"prefix"}


def test_name_resolution_prefix_then_fuzzy(spark):
    names = spark.createDataFrame([(0, "Datos A2"), (1, "Datos B"), (2, "Resumen")], "o INT, n STRING")
    left = spark.createDataFrame([("datos",), ("resumen ",), ("Dtos B",), ("zzz",)], "w STRING")
    out = {r.w: (r.match_value, r.match_method) for r in
           match_labels(left, "w", names, "n", "n", "o", threshold=0.6, metric="ratcliff", mode="name").collect()}
    assert out["datos"] == ("Datos A2", "prefix")
    assert out["resumen "] == ("Resumen", "prefix")
    assert out["Dtos B"] == ("Datos B", "fuzzy")
    assert out["zzz"] == (None, None)


def test_question_matrix_diagnostics(spark):
    from pulso.plans.question_matrix import question_matrix
    from pulso.sources.dims import Question

    answers = spark.createDataFrame([(1, "Q1", "4")], "row_ord BIGINT, question_id STRING, score_raw STRING")
    resp = spark.createDataFrame([(1, "1", "gen z", "Entusiasta")], "row_ord BIGINT, id STRING, cohort_raw STRING, nps_raw STRING")
    tpl = spark.createDataFrame([(0, "1", "¿Cómo es la cultura?", None, None, 1.0), (1, "2", "cultura como es la", None, None, None)],
                                "template_ord BIGINT, index STRING, question STRING, clima STRING, ife STRING, weight DOUBLE")
    out = question_matrix(answers, resp, [Question("Q1", "Como es la cultura")], template=tpl, diagnostics=True)
    rows = {r.template_ord: r for r in out.collect()}
    assert (rows[0].question_id, rows[0].match_method, rows[0].general, rows[0].centenialls) == ("Q1", "normalized", 10.0, 10.0)
    assert rows[1].question_id is None and rows[1].general is None and rows[1].weight is None


def test_best_and_sole_fallback(spark):
    names = spark.createDataFrame([(0, "Datos A2"), (1, "Resumen")], "o INT, n STRING")
    left = spark.createDataFrame([("Resumen",), ("datos a3",), ("zzz",)], "w STRING")
    out = {r.w: (r.match_value, r.match_method) for r in
           match_labels(left, "w", names, "n", "n", "o", metric="ratcliff", mode="best").collect()}
    assert out == {"Resumen": ("Resumen", "exact"), "datos a3": ("Datos A2", "fuzzy"), "zzz": ("Datos A2", "fallback")}
    only = spark.createDataFrame([(0, "Hoja1")], "o INT, n STRING")
    got = match_labels(left, "w", only, "n", "n", "o", threshold=0.6, mode="name", sole_fallback=True).collect()
    assert {r.match_value for r in got} == {"Hoja1"}


def test_ratcliff_query_against_brute_force(spark):
    """label_match_ratcliff vs a plain-Python cascade over every part row."""
    import pandas as pd

    import __spark_entry__ as entry
    from pulso.sources.fixtures import FIXTURE_QUESTIONS

    sf = "/root/testdata/sf0.001"

    # The labels use these accents and marks only.
    def loose(s):
        return "".join(c for c in s.lower().translate(str.maketrans("áéíóúñ", "aeioun")) if c not in "()!¡.")

    labels = [q.label for q in FIXTURE_QUESTIONS]
    ids = [q.question_id for q in FIXTURE_QUESTIONS]
    exact = dict(zip(labels, ids))
    norm = {loose(lab): qid for lab, qid in zip(labels, ids)}
    expected = {}
    for k, name in pd.read_parquet(f"{sf}/part.parquet", columns=["p_partkey", "p_name"]).itertuples(index=False):
        lab, kind, pos = labels[k % 7], (k // 7) % 4, k % 20 + 1
        wanted = [lab, lab[:pos - 1] + lab[pos:], "¡" + lab.upper() + "!", name][kind]
        if wanted in exact:
            expected[k] = (exact[wanted], "exact")
        elif loose(wanted) in norm:
            expected[k] = (norm[loose(wanted)], "normalized")
        else:
            best, best_s = None, 0.0
            for key, qid in norm.items():
                s = SequenceMatcher(None, loose(wanted), key).ratio()
                if s > best_s:
                    best, best_s = qid, s
            expected[k] = (best, "fuzzy") if best_s >= 0.75 else (None, None)
    got = {r.p_partkey: (r.match_value, r.match_method)
           for r in entry.queries()["label_match_ratcliff"](spark, sf).collect()}
    assert got == expected
    assert {m for _, m in got.values()} == {"exact", "normalized", "fuzzy", None}


def test_bigint_ordinals(spark):
    big = 2**31 + 7
    dim = spark.createDataFrame([(big, "alpha beta", "x"), (big + 1, "gamma", "y"), (big + 2, "alpha bete", "z")], "ord BIGINT, label STRING, question_id STRING")
    left = spark.createDataFrame([("alpha beto",), ("gamma",)], "q STRING")
    for cap in (0, 5000):
        for metric in ("ratcliff", "levenshtein"):
            got = {r.q: r.match_value for r in match_labels(left, "q", dim, metric=metric, max_inline=cap).collect()}
            assert got == {"alpha beto": "x", "gamma": "y"}


def _texts(n, seed):
    import random

    rng = random.Random(seed)
    words = ["red", "blue", "small", "ring", "bolt", "gear", "widget", "año", "aaaa", "b"]
    out = {"", "a", "aa", "ab", "é"}
    while len(out) < n:
        t = " ".join(rng.choices(words, k=rng.randint(1, 5)))
        for _ in range(rng.randint(0, 3)):
            i = rng.randint(0, len(t))
            t = t[:i] + rng.choice(["", "x", "e", "aa"]) + t[i + rng.randint(0, 2):]
        out.add(t)
    return sorted(out)


def _lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def test_similarity_join_loses_no_pair(spark, monkeypatch):
    from pulso.operators import similarity_join as sj

    a, b = _texts(70, 1), _texts(90, 2)
    left, right = (spark.createDataFrame([(t,) for t in x], "text STRING") for x in (a, b))
    measures = {"ratcliff": lambda x, y: SequenceMatcher(None, x, y).ratio(), "levenshtein": _lev}
    for postings in (4096, 3):
        monkeypatch.setattr(sj, "POSTINGS", postings)
        for metric, measure in measures.items():
            for t in (0.1, 0.5, 0.7, 0.85, 0.95) if postings == 4096 else (0.7,):
                want = {(x, y) for x in a for y in b if x and y and measure(x, y) >= t}
                got = [tuple(r) for r in sj.candidates(left, right, t, metric).collect()]
                assert len(got) == len(set(got)) and want <= set(got), (metric, t)


def test_bounds_hold_for_every_partner_length():
    """The bound of a pair falls by whole edits or blocks between neighbouring lengths; what a text is asked for never exceeds it."""
    import math

    from pulso.operators import similarity_join as sj

    for metric in sj.METRICS:
        for t in (0.1, 0.5, 0.55, 0.6, 0.68, 0.74, 0.75, 0.8, 0.9, 0.95, 1.0):
            q, shrink = sj._gram(t, metric), sj._shrink(t, metric)
            for n in range(1, 90):
                for m in range(max(1, math.ceil(n * shrink - 1e-9)), math.floor(n / shrink + 1e-9) + 1 if shrink else 200):
                    for gram in {1, q}:
                        if metric == "ratcliff":
                            matched = math.ceil((n + m) * t / 2 - 1e-9)
                            pair = matched if gram == 1 else 3 * matched - 1 - (n + m)
                        else:
                            pair = max(n, m) - (gram - 1) - gram * math.floor(max(n, m) * (1 - t) + 1e-9)
                        asked = sj._least_shared(n, t, metric, gram, math.ceil)
                        assert asked <= max(pair, 0), (metric, t, n, m, gram)


def test_similarity_join_meets_far_less_than_all_pairs_of_near_lengths(spark):
    """Names of parts against each other, which share most of their words: candidates beside pairs whose lengths alone allow a match."""
    from pyspark.sql import functions as F

    from pulso.operators.similarity_join import candidates, scored

    p = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    names = p.select(F.concat_ws(" ", "p_name", "p_type", "p_brand", F.col("p_partkey").cast("string")).alias("text")).distinct()
    texts = [r[0] for r in names.collect()]
    for metric, shrink in (("levenshtein", 0.9), ("ratcliff", 0.9 / 1.1)):
        met = candidates(names, names, 0.9, metric)
        near = sum(min(len(a), len(b)) >= shrink * max(len(a), len(b)) for a in texts for b in texts)
        assert len(texts) <= scored(met, 0.9, metric).count() <= met.count() < near / 4


def test_pairs_of_one_edit_meet_without_frequent_grams(spark):
    """Numbered names share all their grams with a fixed part of the others: who meets grows with the names, not with their pairs."""
    from pyspark.sql import functions as F

    from pulso.operators.similarity_join import candidates, scored

    met = {}
    for n in (500, 4000):
        k = F.col("id") * 7919 % 100_000
        names = spark.range(n).select("id", F.format_string("supplier%09d %s", k, F.element_at(F.array(*map(F.lit, ["france", "peru", "japan"])), (k % 3 + 1).cast("int"))).alias("text"))
        pos = (F.col("id") % 15 + 1).cast("int")
        wanted = names.select(F.concat(F.expr("left(text, int(id % 15))"), F.substring("text", pos + 1, F.length("text"))).alias("text")).distinct()
        pairs = candidates(wanted, names.select("text"), 0.95, "levenshtein").cache()
        assert scored(pairs, 0.95, "levenshtein").select("probe").distinct().count() == wanted.count()
        met[n] = pairs.count()
        pairs.unpersist()
    assert met[4000] < 16 * met[500] and met[4000] < 4 * 4000, met


def test_pairs_of_one_edit_and_of_more_are_all_found(spark, monkeypatch):
    """Lengths on both sides of the place where a second edit is allowed, of the one where the first is, and of the longest shortened text."""
    import random

    from pulso.operators import similarity_join as sj

    rng, texts = random.Random(5), ["a", "b", "aa", "aaa", "é", "ab", "ba"]
    for n in (4, 5, 6, 9, 10, 11, 18, 19, 20, 21, 38, 39, 40, 41, 42):
        base = "".join(rng.choices("ab1é", k=n))
        texts.append(base)
        for _ in range(4):
            t = base
            for _ in range(rng.randint(1, 3)):
                i = rng.randint(0, len(t))
                t = t[:i] + rng.choice(["", "b", "2", "é"]) + t[i + rng.randint(0, 1):]
            texts.append(t)
    texts = sorted(set(texts) - {""})
    side = spark.createDataFrame([(t,) for t in texts], "text STRING")
    for longest in (128, 20):
        monkeypatch.setattr(sj, "ONE_EDIT", longest)
        for t in (0.0, 0.5, 0.8, 0.9, 0.95, 1.0) if longest == 128 else (0.95,):
            want = {(x, y) for x in texts for y in texts if _lev(x, y) >= t and _lev(x, y) > 0}
            met = [tuple(r) for r in sj.candidates(side, side, t, "levenshtein").collect()]
            assert len(met) == len(set(met)) and want <= set(met), (t, longest)
