"""Sources and sinks: mapping files, template table, CSV survey reader, report publish modes."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

from pulso.operators.hierarchy import hierarchy_report
from pulso.sources.dims import (demographic_groups, hierarchy_nodes, load_demographic_mapping, load_hierarchy_mapping,
                                parse_letters, read_demographic_json, read_hierarchy_json, template_from_table)
from pulso.sources.io import list_reports, read_report, read_survey, write_report


def _tmp() -> Path:
    return Path(tempfile.mkdtemp(prefix="pulso-io-"))


def test_hierarchy_mapping_file(spark):
    d = _tmp()
    mapping = {"rows": [
        {"label": "Top", "kind": "group", "columns": ["ia"], "children": ["a", "b"], "groupAggregation": "unweighted"},
        {"label": "a", "kind": "value", "columns": "ic, id"},
        {"label": "b", "kind": "value", "columns": ["ie"]},
    ], "defaults": {"groupAggregation": "unweighted"}}
    (d / "h.json").write_text(json.dumps(mapping), encoding="utf-8")
    nodes, defaults = load_hierarchy_mapping(d / "h.json")
    assert [n.label for n in nodes] == ["Top", "a", "b"] and nodes[1].columns == ("ic", "id")
    assert defaults["groupAggregation"] == "unweighted"
    dist = read_hierarchy_json(spark, str(d / "h.json")).orderBy("node_ord").collect()
    assert [r.label for r in dist] == ["Top", "a", "b"] and dist[0].children == ["a", "b"]
    assert [r.columns for r in dist] == [["ia"], ["ic", "id"], ["ie"]] and dist[1].kind == "value"
    assert hierarchy_nodes(read_hierarchy_json(spark, str(d / "h.json"))) == (nodes, defaults)
    answers = spark.createDataFrame([(1, "IC", "4"), (1, "ID", "2"), (1, "IE", "1")],
                                    "row_ord BIGINT, question_id STRING, score_raw STRING")
    out = {r.node: r.scale4 for r in hierarchy_report(answers, nodes).collect()}
    assert out == {"Top": 2.0, "a": 3.0, "b": 1.0}


def test_demographic_mapping_file(spark):
    d = _tmp()
    (d / "m.json").write_text(json.dumps({"defaults": {"npsColumn": "GV"}, "groups": [
        {"group": "G", "column": "CD", "order": ["0 A"], "normalize": {"a": "0 A"}},
        {"group": "H", "column": "?"}]}), encoding="utf-8")
    groups, defaults = load_demographic_mapping(d / "m.json")
    assert demographic_groups(read_demographic_json(spark, str(d / "m.json"))) == (groups, defaults)
    assert groups[0].normalize == {"a": "0 A"} and groups[1].order == () and defaults["npsColumn"] == "GV"
    assert parse_letters("ic, id,") == ["ic", "id"] and parse_letters(["IA"]) == ["IA"]


def test_template_table(spark):
    df = spark.createDataFrame([(1, "1.1", " ¿Cómo? ", "x", "2,5"), (2, None, "Otra", None, "3")],
                               "template_ord BIGINT, index STRING, Pregunta STRING, Clima STRING, PESO STRING")
    rows = template_from_table(df).orderBy("template_ord").collect()
    assert [(r.question, r.clima, r.ife, r.weight) for r in rows] == [("¿Cómo?", "x", None, None), ("Otra", None, None, 3.0)]
    assert template_from_table(spark.createDataFrame([(1,)], "other INT")) is None


def test_csv_reader_na_tokens(spark):
    d = _tmp()
    (d / "s.csv").write_text("ID,NPS,Score\n1,Entusiasta,3\n2,N/A,NA\n3,#N/A,\n", encoding="utf-8")
    rows = read_survey(spark, str(d / "s.csv"), fmt="csv").orderBy("ID").collect()
    assert [(r.NPS, r.Score) for r in rows] == [("Entusiasta", "3"), (None, None), (None, None)]


def test_csv_files_split_unless_cells_hold_line_breaks(spark):
    d = _tmp()
    (d / "s.csv").write_text("ID,Note\n" + "".join(f"{i},word{i}\n" for i in range(20000)), encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert read_survey(spark, str(d / "s.csv"), fmt="csv").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    (d / "m.csv").write_text('ID,Note\n1,"two\nlines"\n', encoding="utf-8")
    assert read_survey(spark, str(d / "m.csv"), fmt="csv", multiLine="true").first()["Note"] == "two\nlines"


def test_report_publish_modes(spark):
    base = str(_tmp() / "reports")
    df = spark.createDataFrame([(1,)], "x INT")
    for name in ("a", "b", "c"):
        write_report(df, base, name)
    assert list_reports(spark, base) == ["a", "b", "c"]
    write_report(df, base, "b", drop=["a", "b"])          # never drops the report just written
    assert list_reports(spark, base) == ["b", "c"]
    write_report(df, base, "d", mode="only")
    assert list_reports(spark, base) == ["d"]
    assert read_report(spark, base, "d").count() == 1
