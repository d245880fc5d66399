"""Sums without an order."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pulso.functions import exact
from pulso.functions.numeric import likert_score
from pulso.plans import kpis


def _sum(df):
    return df.agg(*exact.sums(F.col("v"), "x")).agg(exact.total("x")).first()[0]


CASES = {
    "cents": lambda r: r.randint(-10**7, 10**7) / 100,
    "tenths": lambda r: r.randint(0, 100) / 10,
    "magnitudes": lambda r: r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-9, 15),
    "small": lambda r: r.random() * 1e-9 + 1e-9,
    "cancelling": lambda r: r.choice([1e15, -1e15, 0.1, 1e-9]),
}


@pytest.mark.parametrize("case", CASES)
def test_same_bits_for_any_partitioning_and_equal_to_fsum(spark, case):
    rng = random.Random(case)
    values = [CASES[case](rng) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = {_sum(df.repartition(n, F.rand(n))) for n in (1, 3, 7)}
    assert len(got) == 1
    total = got.pop()
    assert abs(Fraction(total) - sum(map(Fraction, values))) <= Fraction(math.ulp(total)) and math.isclose(total, math.fsum(values), rel_tol=2**-52)
    if case in ("cents", "tenths", "magnitudes"):
        assert total == math.fsum(values)


def test_odd_values_and_nothing(spark):
    run = lambda vs: _sum(spark.createDataFrame([(v,) for v in vs], "v DOUBLE"))
    assert run([]) is None and run([None, None]) is None and run([None, 1.5]) == 1.5
    assert run([math.inf, 1.0]) == math.inf and math.isnan(run([math.nan, 1.0])) and math.isnan(run([math.inf, -math.inf]))
    assert run([1e300, 0.5]) == 1e300 and run([-0.0]) == 0.0 and run([-0.75, 0.25]) == -0.5


def test_likert_means_do_not_flip_at_a_tie(spark):
    values = [1.1, 2.3, 3.7, 1.9, 2.05, 3.35] * 50
    df = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "i INT, v STRING")
    s = likert_score(F.col("v"))
    got = {df.repartition(n, F.rand(n)).agg(exact.likert_mean(exact.likert_sum(s), F.count(s))).first()[0] for n in (1, 2, 5)}
    assert got == {float(sum(map(Fraction, values))) / len(values)}


def test_satisfaction_mean_keeps_its_bits(spark):
    rng = random.Random(3)
    rows = [(str(i), "Gen X", "Pasivo", str(rng.randint(1, 100) / 10)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id STRING, cohort_raw STRING, nps_raw STRING, satisfaction_raw STRING")
    means = {tuple(kpis.satisfaction_by_cohort(kpis.kpi_cube(df.repartition(n, F.rand(n)))).first()) for n in (1, 4)}
    assert len(means) == 1
