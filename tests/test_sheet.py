"""Letter-addressed worksheets: letters, wide->canonical split, and report equivalence."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulso.plans import kpis
from pulso.plans.sheet import sheet_reports
from pulso.sources import fixtures as fx
from pulso.sources import layout
from pulso.sources.dims import DemographicGroup, Question
from pulso.sources.letters import index_to_letter, letter_to_index, select_letters

SF = "/root/testdata/sf0.001"


def test_letters_round_trip():
    assert [letter_to_index(x) for x in ("A", "Z", "AA", "az", "IZ", "GV", "?", "", None, "Á")] == \
        [0, 25, 26, 51, 259, 203, -1, -1, -1, 0]
    assert all(letter_to_index(index_to_letter(i)) == i for i in range(800))


def _sheet(spark):
    """A 262-column sheet: fixture respondents at their role letters, Q1..Q7 at AL..AR
    and at the sub-components IC..IF / IH..IJ."""
    r = fx.respondents(spark, SF)
    a = fx.answers(spark, SF)
    # A sheet cell holds one value; (row_ord, question) repeats in the fixture,
    # so both sides use the same deterministic pick per cell.
    wide = a.groupBy("row_ord").pivot("question_id", [f"Q{i}" for i in range(1, 8)]).agg(F.min("score_raw"))
    j = r.join(wide, "row_ord", "left")
    place = {"A": "id", "E": "satisfaction_raw", "GU": "cohort_raw", "GV": "nps_raw", "CM": "dem_segment_raw",
             "AL": "Q1", "AM": "Q2", "AN": "Q3", "AO": "Q4", "AP": "Q5", "AQ": "Q6", "AR": "Q7",
             "IC": "Q1", "ID": "Q2", "IE": "Q3", "IF": "Q4", "IH": "Q5", "II": "Q6", "IJ": "Q7"}
    cols = []
    for i in range(261):
        src = place.get(index_to_letter(i))
        cols.append((F.col(src) if src else F.lit(None)).cast("string").alias(f"c{i}"))
    cols.append(F.col("row_ord"))
    return j.select(*cols)


def test_select_letters_out_of_range(spark):
    df = spark.createDataFrame([("1", "x")], "a STRING, b STRING")
    row = select_letters(df, {"first": "A", "second": "b", "gone": "ZZ"}, missing="").first()
    assert (row.first, row.second, row.gone) == ("1", "x", "")


def test_sheet_kpis_match_canonical(spark):
    sheet = _sheet(spark)
    reports = sheet_reports(sheet, demographics=[DemographicGroup("SEG", "CM", (), {}),
                                                 DemographicGroup("NONE", "?", ())],
                            universe=100.0, row_ord_col="row_ord")
    row = reports["consolidado"].first()
    canon_q = [Question(f"Q{i}", f"Q{i}", "A" if i <= 4 else "B") for i in range(1, 8)]
    cells = fx.answers(spark, SF).groupBy("row_ord", "question_id").agg(F.min("score_raw").alias("score_raw"))
    ref = kpis.survey_kpis(fx.respondents(spark, SF), cells, canon_q, universe=100.0).first()
    for i, letter in enumerate(["AL", "AM", "AN", "AO", "AP", "AQ", "AR"], start=1):
        assert row[f"q_{letter}"] == ref[f"q_Q{i}"]
    assert row["axis_IB"] == ref["axis_A"]          # IC..IF carry Q1..Q4
    assert row["axis_IG"] == ref["axis_B"]          # IH..IJ carry Q5..Q7
    assert row["nps"] == ref["nps"] and row["respuestas"] == ref["respuestas"]
    assert row["q_AS"] == 0.0 and row["axis_IL"] == 0.0   # empty columns report 0.0
    mat = {r.question_id: r.general for r in reports["por_pregunta"].collect()}
    assert len(mat) == len(layout.QUESTION_LABELS) and mat["AL"] == ref["q_Q1"]
    dem = reports["demografia"].collect()
    assert {r.grupo for r in dem} == {"SEG"}
    assert sum(r.general for r in dem) == fx.respondents(spark, SF).count()
    assert reports["comentarios"].columns[0] == "id"


def test_sheet_hierarchy_with_letter_mapping(spark):
    from pulso.sources.dims import HierarchyNode

    nodes = [HierarchyNode("Top", "group", ("ib",), ("A", "B")),
             HierarchyNode("A", "value", ("ic", "id")), HierarchyNode("B", "value", ("ie",))]
    reports = sheet_reports(_sheet(spark), hierarchy=nodes, universe=1.0, row_ord_col="row_ord")
    out = {r.node: r.scale4 for r in reports["indice_clima"].collect()}
    cells = fx.answers(spark, SF).groupBy("row_ord", "question_id").agg(F.min("score_raw").alias("score_raw"))
    from pulso.operators.hierarchy import hierarchy_report
    canon = [HierarchyNode("Top", "group", ("q9",), ("A", "B")),
             HierarchyNode("A", "value", ("q1", "q2")), HierarchyNode("B", "value", ("q3",))]
    ref = {r.node: r.scale4 for r in hierarchy_report(cells, canon).collect()}
    assert out == ref and out["Top"] is not None


def test_sheet_comments_respect_id_filter(spark):
    sheet = _sheet(spark)
    some_id = sheet.select("c0").first()[0]
    reports = sheet_reports(sheet, universe=1.0, ids=[f" {some_id} "], row_ord_col="row_ord")
    ids = {r.id for r in reports["comentarios"].collect()}
    assert ids == {some_id}
    assert reports["consolidado"].first()["respuestas"] <= sheet.filter(sheet.c0 == some_id).count()


def test_sheet_out_of_a_shuffle_needs_no_ordinal(spark):
    """Cohort and NPS ride along with the answers: a re-dealt sheet without an ordinal gives the keyed sheet's scores."""
    sheet = _sheet(spark)
    keyed = sheet_reports(sheet, universe=1.0, row_ord_col="row_ord")
    keys = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1000")
    try:
        dealt = sheet.join(sheet.select("c0", "row_ord").distinct(), ["c0", "row_ord"]).select(*sheet.columns[:-1]).repartition(7)
        loose = sheet_reports(dealt, universe=1.0)
        for name in ("por_pregunta", "consolidado"):
            assert sorted(map(str, loose[name].collect())) == sorted(map(str, keyed[name].collect()))
        plan = loose["por_pregunta"]._jdf.queryExecution().optimizedPlan().toString()
        assert "monotonically" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keys)


def test_demographics_ask_for_an_ordinal(spark):
    import pytest

    with pytest.raises(ValueError, match="row_ord_col"):
        sheet_reports(_sheet(spark), demographics=[DemographicGroup("SEG", "CM", (), {})])
