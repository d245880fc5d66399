"""Scalar functions: normalisation, predicates, coercion, rounding, rescaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulso.functions import numeric as N
from pulso.functions import text as T


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x STRING")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_norm_label_matches_python_rule(spark):
    values = ["Generación  Z", " ÁRBOL\tñandú ", "Çà　va", "İstanbul", "x\x1cy", "crème brûlée",
              "Ελληνικά τόνος", "Ёлка", "  ", "", None, "Baby\nBoomers"]
    got = _one_col(spark, values, T.norm_label)
    want = ["generacion z", "arbol nandu", "ca va", "istanbul", "x y", "creme brulee", "ελληνικα τονος", "елка", "", "", None, "baby boomers"]
    assert got == want
    assert [T.plain_label(v) if v is not None else None for v in values] == want
    assert [T.plain_label(v, loose=True) for v in ("¿Cómo es la cultura?", "a - b", "a_b")] == ["como es la cultura", "a  b", "ab"]


def test_norm_label_loose_drops_punctuation_after_collapse(spark):
    got = _one_col(spark, ["¿Cómo es la cultura?", "a - b", "Sí, (claro)!"], T.norm_label_loose)
    assert got == ["como es la cultura", "a  b", "si claro"]


def test_strip_numeric_prefix(spark):
    got = _one_col(spark, ["5 o más", "0 Femenino", "12a b", "Otro", "5", None], T.strip_numeric_prefix)
    assert got == ["o más", "Femenino", "b", "Otro", "5", None]


def test_answered_predicates(spark):
    values = [None, "", " N/A ", "n\\a", "–", "s/d", "SD", "?", "Entusiasta", " 7 ", "ñ", "nan", "None"]
    raw = _one_col(spark, values, T.answered_raw)
    assert raw == [False, False, False, False, False, False, False, False, True, True, False, False, False]
    nonempty = _one_col(spark, values, T.nonempty_label)
    # F2c has no alphanumeric test: "?" and "ñ" are categories.
    assert nonempty == [False, False, False, False, False, False, False, True, True, True, True, False, False]


def test_to_number_and_clip(spark):
    values = [" 3.5 ", "1e0", "3,5", "3.5d", "NaN", "Infinity", "true", "", None, "-2", ".5", "7"]
    got = _one_col(spark, values, N.to_number)
    assert got == [3.5, 1.0, None, None, None, None, None, None, None, -2.0, 0.5, 7.0]
    clipped = _one_col(spark, values, N.likert_score)
    assert clipped == [3.5, 1.0, None, None, None, None, None, None, None, 1.0, 1.0, 4.0]


def test_scale4_to_10_all_inputs(spark):
    means = [1.0 + i / 10 for i in range(31)]
    df = spark.createDataFrame([(m,) for m in means], "m DOUBLE")
    got = [r[0] for r in df.select(N.scale4_to_10("m")).collect()]
    expected = [round((round(m, 1) - 1.0) * (10.0 / 3.0), 1) for m in means]
    assert got == expected
    # mean exactly 1.0 rescales to 0.0, the "no data" value
    assert got[0] == 0.0


def test_bround_is_half_even_on_decimal(spark):
    df = spark.createDataFrame([(2.25,), (2.35,), (1.05,), (0.125,)], "v DOUBLE")
    assert [r[0] for r in df.select(N.round_half_even("v", 1)).collect()][:3] == [2.2, 2.4, 1.0]


def test_pct_and_safe_ratio(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (5, None)], "a INT, b INT")
    got = [tuple(r) for r in df.select(N.pct("a", "b"), N.safe_ratio("a", "b")).collect()]
    assert got == [(33.33, 1 / 3), (0.0, 0.0), (0.0, 0.0)]


def test_fixed_and_universe(spark):
    from pulso.plans.kpis import parse_universe

    df = spark.createDataFrame([(4.25,), (10.0,)], "v DOUBLE")
    # display text only: the JVM formatter rounds ties half-up
    assert [r[0] for r in df.select(N.fixed("v", 1)).collect()] == ["4.3", "10.0"]
    assert [r[0] for r in df.select(N.fixed("v", 2)).collect()] == ["4.25", "10.00"]
    assert (parse_universe("1,5"), parse_universe(" "), parse_universe(None), parse_universe(12)) == (1.5, 0.0, 0.0, 12.0)
