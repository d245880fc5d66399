"""Report operators on hand-built inputs with hand-computed results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pulso.operators.apportion import apportion
from pulso.operators.hierarchy import hierarchy_report, roots, visit_order
from pulso.operators.segments import filter_ids, filter_ids_table
from pulso.plans import demographics as demo
from pulso.plans import kpis
from pulso.sources.dims import DemographicGroup, HierarchyNode, Question

RESP_SCHEMA = "row_ord BIGINT, id STRING, cohort_raw STRING, nps_raw STRING, satisfaction_raw STRING"


def _resp(spark):
    rows = [
        (1, "10", "Centennials", "Entusiasta", "8"),
        (2, " 11", "gen z", "Detractor", "4"),
        (3, "12", "Baby Boomers", "pasivo", "N/A"),
        (4, "13", "Otro", "No aplica", "6"),
        (5, "14", None, None, None),
        (6, "15", "X", "s/d", "10"),
    ]
    return spark.createDataFrame(rows, RESP_SCHEMA)


def test_nps_counts_unknown_in_denominator(spark):
    cube = kpis.kpi_cube(_resp(spark))
    r = kpis.nps_overall(cube).first()
    # answered: Entusiasta, Detractor, pasivo, No aplica -> V = 4 (s/d and NULL are empty)
    assert (r.promoters, r.detractors, r.nps_base, r.nps) == (1, 1, 4, 0.0)
    pcts = kpis.nps_category_pct(cube).first()
    assert (pcts.pct_promoter, pcts.pct_passive, pcts.pct_detractor) == (25.0, 25.0, 25.0)


def test_cohort_share_uses_all_rows(spark):
    rows = {r.cohort: (r.n_cohort, r.pct) for r in kpis.cohort_share(kpis.kpi_cube(_resp(spark))).collect()}
    assert rows["centenialls"] == (2, 33.33)
    assert rows["baby boomers"] == (1, 16.67)
    assert rows["milenialls"] == (0, 0.0)


def test_satisfaction_means_skip_junk(spark):
    r = kpis.satisfaction_by_cohort(kpis.kpi_cube(_resp(spark))).first()
    assert r.satisfaction_general == 7.0  # (8 + 4 + 6 + 10) / 4
    assert r.satisfaction_centenialls == 6.0
    assert r.satisfaction_baby_boomers == 0.0  # only "N/A"


def test_responded_count_zero_universe(spark):
    r = kpis.responded_count(kpis.kpi_cube(_resp(spark)), 0).first()
    assert (r.responses, r.participation) == (4, 0.0)
    r = kpis.responded_count(kpis.kpi_cube(_resp(spark)), 8).first()
    assert r.participation == 50.0


@pytest.mark.parametrize("ids,expected", [(["999"], 0), (["11", " 12 "], 2), (None, 6)])
def test_id_filter_keeps_none_some_all(spark, ids, expected):
    assert filter_ids(_resp(spark), ids).count() == expected


def test_id_filter_native_type_pushes_down(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id BIGINT")
    out = filter_ids(df, ["2", " 3"])
    assert sorted(r.id for r in out.collect()) == [2, 3]
    ids = spark.createDataFrame([(" 13",), ("12",)], "x STRING")
    assert filter_ids_table(_resp(spark), ids, "id", "x").count() == 2


@pytest.mark.parametrize("kind,top", [("BIGINT", 2**63 - 1), ("INT", 2**31 - 1), ("SMALLINT", 2**15 - 1), ("TINYINT", 127)])
def test_id_filter_takes_the_whole_range_of_the_type(spark, kind, top):
    df = spark.createDataFrame([(top,), (-top - 1,), (top - 1,), (0,)], f"id {kind}")
    ids = [str(top), f" {-top - 1} ", str(top + 1), str(-top - 2), "9" * 25, "-0", "007"]
    assert sorted(r.id for r in filter_ids(df, ids).collect()) == [-top - 1, top]
    assert filter_ids(df, ids[2:]).count() == 0


def test_survey_kpis_row(spark):
    answers = spark.createDataFrame(
        [(1, "Q1", "4"), (2, "Q1", "1"), (3, "Q1", "n/a"), (1, "Q2", "1"), (2, "Q2", "0.5"), (4, "Q3", "9")],
        "row_ord BIGINT, question_id STRING, score_raw STRING")
    qs = [Question("Q1", "uno", "A"), Question("Q2", "dos", "A"), Question("Q3", "tres", "B"),
          Question("Q4", "cuatro", "B")]
    row = kpis.survey_kpis(_resp(spark), answers, qs, universe=10).first()
    # Q1 mean 2.5 -> 5.0; Q2 mean 1.0 -> 0.0 (no data for the parent); Q3 clipped 4 -> 10.0; Q4 none
    assert (row.q_Q1, row.q_Q2, row.q_Q3, row.q_Q4) == (5.0, 0.0, 10.0, 0.0)
    assert (row.axis_A, row.axis_B) == (5.0, 10.0)
    assert row.indice_clima == 7.5
    assert row.respuestas == 4 and row.pct_participacion == 40.0 and row.covid == ""


def test_hierarchy_fallback_and_order(spark):
    nodes = [
        HierarchyNode("Root", "group", ("c1",), ("G1", "G2")),
        HierarchyNode("G1", "group", ("c1",), ("v1", "v2")),
        HierarchyNode("v1", "value", ("c1",)),
        HierarchyNode("v2", "value", ("c2",)),
        HierarchyNode("G2", "group", ("c3",), ("v3",)),  # child without data -> own columns
        HierarchyNode("v3", "value", ("c9",)),
    ]
    assert roots(nodes) == ["Root"]
    assert visit_order(nodes) == ["Root", "G1", "v1", "v2", "G2", "v3"]
    answers = spark.createDataFrame(
        [(1, "c1", "4"), (2, "c1", "3"), (1, "c2", "2"), (1, "c3", "1"), (2, "c3", "2")],
        "row_ord BIGINT, question_id STRING, score_raw STRING")
    out = {r.node: (r.real, r.scale4, r.scale10) for r in hierarchy_report(answers, nodes).collect()}
    assert out["v1"] == (3.5, 3.5, 8.3)
    assert out["v2"] == (2.0, 2.0, 3.3)
    assert out["v3"] == (None, None, None)
    assert out["G1"] == (2.75, 2.8, 5.8)  # mean of children, e4/e10 re-rounded
    assert out["G2"] == (1.5, 1.5, 1.7)   # fallback to its own column c3
    assert out["Root"] == (2.125, 2.2, 3.8)


def test_apportion_three_equal_and_zero(spark):
    df = spark.createDataFrame([("g", 0, 1), ("g", 1, 1), ("g", 2, 1), ("z", 0, 0)], "g STRING, i INT, w INT")
    out = {(r.g, r.i): r.v for r in apportion(df, ["g"], "w", 10000, ["i"], "v").collect()}
    assert [out[("g", i)] for i in range(3)] == [0.3334, 0.3333, 0.3333]
    assert out[("z", 0)] is None


def test_demographics_report_edge_cases(spark):
    rows = [(1, "femenino", "Entusiasta"), (2, "FEMENINO", "Detractor"), (3, "Masculino", "pasivo"),
            (4, "1 Masculino", None), (5, "n/a", "Entusiasta"), (6, "Otro género", "Entusiasta"),
            (7, "masculino ", "s/d")]
    df = spark.createDataFrame(rows, "row_ord BIGINT, gen STRING, nps_raw STRING")
    groups = [DemographicGroup("GENERO", "gen", ("0 Femenino", "1 Masculino"), {"femenino": "0 Femenino"}),
              DemographicGroup("NADA", "?", ("0 a",))]
    rep = demo.demographic_report(df, groups).orderBy("index").collect()
    assert [r.variable for r in rep] == ["femenino", "Masculino", "Otro género"]
    assert [r.general for r in rep] == [2, 3, 1]
    assert sum(round(r.pct * 10000) for r in rep) == 10000
    # global valid NPS = 5 (NULL and s/d excluded); shares are rounded before W2
    assert [(r.detractores, r.pasivos, r.entusiastas) for r in rep] == [(1, 0, 1), (0, 1, 0), (0, 0, 1)]
    total = sum(round((r.pct_detractores + r.pct_pasivos + r.pct_entusiastas) * 100) for r in rep)
    assert total == 100
    pre = demo.demographic_report(df, groups, label_mode="prefixed").orderBy("index").collect()
    assert [r.variable for r in pre] == ["0 Femenino", "1 Masculino", "Otro género"]
    nop = demo.demographic_report(df, groups, label_mode="no-prefix").orderBy("index").collect()
    assert [r.variable for r in nop] == ["Femenino", "Masculino", "Otro género"]


def test_demographics_nps_zero_sum_gives_zeros(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "s/d")], "row_ord BIGINT, v STRING, nps_raw STRING")
    rep = demo.demographic_report(df, [DemographicGroup("V", "v")]).collect()
    assert all((r.pct_detractores, r.pct_pasivos, r.pct_entusiastas) == (0.0, 0.0, 0.0) for r in rep)


def test_results_independent_of_partitioning(spark):
    from pulso.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    base = sorted(map(tuple, demo.demographic_report(fx.respondents(spark, sf), fx.FIXTURE_DEMOGRAPHICS).collect()))
    shuffled = fx.respondents(spark, sf).repartition(7, F.col("cohort_raw"))
    again = sorted(map(tuple, demo.demographic_report(shuffled, fx.FIXTURE_DEMOGRAPHICS).collect()))
    assert base == again


def test_apportion_of_one_large_group_matches_plain_ranking(spark):
    """Thousands of categories with many equal remainders in one group: units go to the largest, ties by index."""
    import random

    rng = random.Random(5)
    weights = [rng.choice([0, 1, 1, 2, 3, 50, rng.randint(1, 999)]) for _ in range(6000)] + [0] * 3
    rows = [(0, i, w) for i, w in enumerate(weights)] + [(1, i, 0) for i in range(3)] + [(2, 0, 7)]
    df = spark.createDataFrame(rows, "g INT, i INT, w BIGINT")
    for units in (100, 10000):
        got = {(r.g, r.i): r.v for r in apportion(df, ["g"], "w", units, ["i"], "v").collect()}
        total = sum(weights)
        floors = [w * units // total for w in weights]
        order = sorted(range(len(weights)), key=lambda k: (-(weights[k] * units % total), k))
        for k in order[:units - sum(floors)]:
            floors[k] += 1
        assert [got[0, i] for i in range(len(weights))] == [f / units for f in floors]
        assert round(sum(got[0, i] for i in range(len(weights))) * units) == units
        assert [got[1, i] for i in range(3)] == [None] * 3 and got[2, 0] == 1.0


def test_heights_of_deep_trees_and_broken_ones():
    import pytest

    from pulso.operators.hierarchy import heights
    from pulso.sources.dims import HierarchyNode

    deep = [HierarchyNode(f"n{i}", "group", (), (f"n{i + 1}",)) for i in range(5000)] + [HierarchyNode("n5000", "value", ("a",))]
    assert heights(deep)["n0"] == 5000
    shared = [HierarchyNode("r", "group", (), ("a", "b")), HierarchyNode("a", "group", (), ("b",)), HierarchyNode("b", "value", ("x",))]
    assert heights(shared) == {"r": 2, "a": 1, "b": 0}
    loop = [HierarchyNode("r", "value", ("x",)), HierarchyNode("a", "group", (), ("b",)), HierarchyNode("b", "group", (), ("c",)), HierarchyNode("c", "group", (), ("a",))]
    with pytest.raises(ValueError, match="cycle"):
        heights(loop)
    with pytest.raises(ValueError, match="no row"):
        heights([HierarchyNode("r", "group", (), ("gone",))])
