from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from pulso.llm import registry, secret_scan

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

KEY = "q7Zk2mVx9LrT4wYb8NcJ5sHd3PfG6uAe1RtKqWzX"
LETTERS = "qZkmVxLrTwYbNcJsHdPfGuAeRtKqWzXoIyMvBjUh"


def _brute(text):
    """Spans found with plain regular expressions and windows counted anew."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    more = []
    hide = lambda m: " " * len(m[0])
    shown = re.sub("[A-Za-z0-9+]+", lambda m: hide(m) if any(w in m[0].lower() for w in secret_scan.ALLOW_WORDS) else m[0], text)
    shown = re.sub(r"([A-Za-z0-9+/_=-])\1{5,}", hide, shown)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", shown):
        c = m[0]
        if re.match("(?i)sha(1|256|384|512)-", c) or re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9/_=+-]*", c):
            continue
        kind = "hex" if re.fullmatch("[0-9a-fA-F]+", c) else "letters" if re.fullmatch("[A-Za-z/_=+-]+", c) else "alnum" if re.fullmatch("[A-Za-z0-9]+", c) else "base64"
        hot = []
        for i in range(len(c) - 19):
            w = c[i:i + 20]
            h = -sum(w.count(x) / 20 * math.log2(w.count(x) / 20) for x in set(w))
            if h >= secret_scan.THRESHOLDS[kind] - 1e-9:
                hot.append(i)
        if hot:
            a, b = m.start() + hot[0], m.start() + hot[-1] + 20
            if not any(s < b and e > a for s, _, e in base):
                more.append((a, 3, b))
    return sorted(base + more)


def _random_texts():
    rng = random.Random(3)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = [None, "", "no secrets here", "é" * 30 + " token=" + "x" * 8, "secret=token:abcdefghij", "PASSWORD : 'hunter2hunter2'",
             "password=short", "AKIA" + "B" * 11, "AKIA" + "B" * 12, "f" * 31, "f" * 32, "ſecret=abcdefgh1",
             "sha256-" + "".join(rng.choice(b64) for _ in range(43)), "123e4567-e89b-12d3-a456-426614174000",
             "example" + "".join(rng.choice(b64) for _ in range(30)), "12345678901234567890123", "wort" * 12,
             "token: " + "".join(rng.choice(b64) for _ in range(300))]
    bits = ["password=", "api_key: ", "Api-Key ", "AKIA", "\U0001F600", "\n", " ", "'", "é", "=", "abc", "0123", "deadbeef" * 4]
    for _ in range(300):
        t = ""
        for _ in range(rng.randint(1, 14)):
            t += rng.choice(bits) if rng.random() < 0.6 else "".join(rng.choice(rng.choice([b64, "0123456789abcdef", "ABCDEF0123456789"])) for _ in range(rng.randint(1, 45)))
        texts.append(t)
    texts += ["path/" + KEY + "/example", "my_sample_" + KEY, KEY + "AAAAAA" + KEY[::-1], "sample_key=" + KEY, "-" * 9 + "dummy" + KEY + "=" + KEY, LETTERS, "a/" + LETTERS,
              "x" * 70000 + "example" + "y" * 70000, "src/main/resources/application/configuration/defaults", "example/" * 50]
    texts.append(" ".join("token=" + "".join(rng.choice(b64) for _ in range(12)) for _ in range(1500)))
    texts.append("".join(rng.choice(b64) for _ in range(3000)))
    return texts


@pytest.fixture(scope="module")
def scanned(spark):
    texts = _random_texts()
    df = spark.createDataFrame([(i, t, "a", "e", i) for i, t in enumerate(texts)], "doc_id long, text string, assign string, entropy string, spans int")
    return texts, df


def test_matches_brute_force(scanned):
    texts, df = scanned
    rows = secret_scan.scan(df).orderBy("doc_id").collect()
    for t, r in zip(texts, rows):
        assert [(s["start"], s["rank"], s["end"]) for s in r["secrets"]] == _brute(t), t
    assert rows[0].asDict().keys() == {"doc_id", "text", "assign", "entropy", "spans", "secrets"}


def test_entropy_findings_exist_and_are_suppressed(scanned):
    texts, df = scanned
    found = {r["doc_id"]: {s["rank"] for s in r["secrets"]} for r in secret_scan.scan(df).collect()}
    assert sum(3 in x for x in found.values()) > 30
    assert not any(found[k] for k in (0, 1, 2, 12, 13, 14, 15, 16))


def test_redact_matches_brute_force(scanned):
    texts, df = scanned
    out = secret_scan.redact(df.withColumn("n_chars", df.doc_id)).orderBy("doc_id").collect()
    for t, r in zip(texts, out):
        spans = _brute(t)
        if not spans:
            assert r["text"] == t and r["n_chars"] == r["doc_id"]
            continue
        want, reach = "", 0
        for s, _, e in spans:
            if s >= reach:
                want += t[reach:s] + "[secret]"
            reach = max(reach, e)
        assert r["text"] == want + t[reach:] and r["n_chars"] == len(r["text"])


def test_query_digests(spark):
    rows = {r["doc_id"]: r for r in registry.op3_secret_scan(spark, "/root/testdata/sf0.1").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for k, r in rows.items():
        spans = _brute(docs[k])
        text = lambda xs: ",".join(f"{secret_scan.KINDS[r]}:{a}:{b}" for a, r, b in xs)
        assert r["spans"] == text(spans)
        assert r["base_sha256"] == hashlib.sha256(text([x for x in spans if x[1] < 3]).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"], r["n_entropy"]] == [sum(x[1] == k for x in spans) for k in range(4)]


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a token=abcdefgh1 b"), (1, "a token=abcdefgh1 b")], "doc_id long, text string")
    assert [len(r["secrets"]) for r in secret_scan.scan(df).collect()] == [1, 1]
    assert secret_scan.scan(df.limit(0)).collect() == []


def test_plan_has_no_python(spark):
    plan = registry.op3_secret_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("text", [f"path/{KEY}/example", f"my_sample_{KEY}", f"{KEY}AAAAAA{KEY}", LETTERS, f"see {LETTERS}."])
def test_a_key_beside_an_allowed_word_is_found_and_masked(spark, text):
    clean = secret_scan.redact(spark.createDataFrame([(1, text)], "doc_id long, text string"), overlaps=True).first()["text"]
    assert "[secret]" in clean and KEY[4:-4] not in clean and LETTERS[4:-4] not in clean


def test_columns_with_working_names_are_kept(spark):
    names = ["__text", "__all", "__row", "__open", "__m_hex", "secrets", "row", "ends", "reach", "clean", "a.b"]
    df = spark.createDataFrame([("token=abcdefgh1 x", *names)], ", ".join(f"`{n}` string" for n in ["text", *names]))
    got = secret_scan.redact(df).first()
    assert list(got.__fields__) == ["text", *names] and tuple(got) == ("[secret] x", *names)
    found = secret_scan.scan(df, out="found").first()
    assert tuple(found)[:-1] == ("token=abcdefgh1 x", *names) and len(found["found"]) == 1
    assert secret_scan.scan(df).columns == [c for c in df.columns if c != "secrets"] + ["secrets"]
