"""Sheets by position: headers that differ, repeat and hold dots, rejects, ordinals, and reports over them."""

from __future__ import annotations

import csv
import gzip
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulso.operators.segments import row_nonblank
from pulso.plans.sheet import sheet_reports
from pulso.sources import layout
from pulso.sources.dims import DemographicGroup
from pulso.sources.io import read_survey
from pulso.sources.letters import by_position, col_at, index_to_letter, letter_to_index, select_letters, wide_to_canonical
from pulso.sources.sheets import read_sheet, reconcile, write_sheet


def _dir() -> Path:
    return Path(tempfile.mkdtemp(prefix="pulso-sheet-"))


def _write(path: Path, records, **kw) -> None:
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, **kw).writerows(records)


def test_reconcile():
    labels, places = reconcile([("a", "b", "a"), ("a", "c", "a", "a"), ("b",), ()])
    assert labels == ("a", "b", "a", "c", "a")
    assert places[("a", "b", "a")] == [0, 1, 2, -1, -1]
    assert places[("a", "c", "a", "a")] == [0, -1, 2, 1, 3]
    assert places[("b",)] == [-1, 0, -1, -1, -1] and places[()] == [-1] * 5


def test_files_with_permuted_missing_additional_and_repeated_labels(spark):
    d = _dir()
    _write(d / "a.csv", [["id", "¿Cómo? 1.5", "x`y", "x`y"], ["1", "p", "u", "v"], ["2", "NA", "", "w,\"q\""]])
    _write(d / "b.csv", [["x`y", "id", "x`y", "more."], ["u3", "3", "v3", "m3"], ["u4", "4"]])
    _write(d / "c.csv", [["¿Cómo? 1.5"], ["p5"]])
    (d / "empty.csv").write_text("")
    (d / "blank.csv").write_text("\n\n")
    sheet = read_sheet(spark, str(d))
    assert sheet.labels == ("id", "¿Cómo? 1.5", "x`y", "x`y", "more.")
    assert sheet.rows.columns == ["c0", "c1", "c2", "c3", "c4"]
    assert {tuple(r) for r in sheet.rows.collect()} == {
        ("1", "p", "u", "v", None), ("2", None, None, 'w,"q"', None), ("3", None, "u3", "v3", "m3"), ("4", None, "u4", None, None), (None, "p5", None, None, None)}
    assert sheet.rejects.count() == 0
    labelled = read_survey(spark, str(d), fmt="csv")
    assert labelled.columns == list(sheet.labels) and labelled.count() == 5


def test_rejects_have_file_place_and_text(spark):
    d = _dir()
    (d / "a.csv").write_text('id,n\n1,x\n2,y,z\n3,"open\n4,z,\n5,a,b,c,d\n6,ok\n', encoding="utf-8")
    (d / "b.csv").write_text('id,n,m\n7,x,y\n8,x,y,z\n', encoding="utf-8")
    sheet = read_sheet(spark, str(d), ordinal=True)
    assert {(r.c0, r.row_ord) for r in sheet.rows.collect()} == {("1", 0), ("4", 3), ("6", 5), ("7", 6)}
    got = {(r.file.rsplit("/", 1)[1], r.split_start, r.row_ord, r.reason, r.record) for r in sheet.rejects.collect()}
    assert got == {("a.csv", 0, 1, "cells", "2,y,z"), ("a.csv", 0, 2, "quotes", '3,"open'), ("a.csv", 0, 4, "cells", "5,a,b,c,d"), ("b.csv", 0, 7, "cells", "8,x,y,z")}


def test_line_breaks_in_labels_and_cells(spark):
    d = _dir()
    _write(d / "a.csv", [["id", "two\nlines"], ["1", "a\nb"], ["2", "c"]])
    with pytest.raises(ValueError, match="multi_line"):
        read_sheet(spark, str(d))
    sheet = read_sheet(spark, str(d), multi_line=True, ordinal=True)
    assert sheet.labels == ("id", "two\nlines")
    assert [tuple(r) for r in sheet.rows.orderBy("row_ord").collect()] == [("1", "a\nb", 0), ("2", "c", 1)]


def test_compressed_files_and_other_separators(spark):
    d = _dir()
    with gzip.open(d / "a.csv.gz", "wt", encoding="utf-8") as f:
        f.write("﻿id;v\n1;a,b\n2;'x'\n")
    sheet = read_sheet(spark, str(d), sep=";")
    assert sheet.labels == ("id", "v") and {tuple(r) for r in sheet.rows.collect()} == {("1", "a,b"), ("2", "'x'")}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_ordinals_follow_the_files_over_many_splits(spark, fmt):
    d = str(_dir() / "s")
    df = spark.range(5000).select((F.col("id") * 7 % 5003).cast("string").alias("k"), F.lit("x" * 40).alias("pad.1")).repartition(5, "k")
    if fmt == "csv":
        write_sheet(df, d)
        files = sorted(Path(d).glob("part-*"))
        want = [r[0] for f in files for r in list(csv.reader(open(f)))[1:]]
    else:
        df.write.parquet(d)
        want = [r[0] for f in sorted(Path(d).glob("part-*")) for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        sheet = read_sheet(spark, d, fmt, ordinal=True)
        assert fmt == "parquet" or spark.read.text(d).rdd.getNumPartitions() > 10
        got = {r["row_ord"]: r["c0"] for r in sheet.rows.collect()}
    finally:
        spark.conf.set(key, old)
    assert [got[i] for i in range(5000)] == want and len(got) == 5000
    assert sheet.labels == ("k", "pad.1")


def test_no_files_rows_and_empty_sheets(spark):
    d = _dir()
    (d / "h.csv").write_text("a.b,c\n")
    sheet = read_sheet(spark, str(d), ordinal=True)
    assert sheet.labels == ("a.b", "c") and sheet.rows.count() == 0 and sheet.rejects.count() == 0
    (_dir() / "x").mkdir()
    e = _dir()
    (e / "z.csv").write_text("")
    empty = read_sheet(spark, str(e))
    assert empty.labels == () and empty.rows.count() == 0


def test_letters_and_row_nonblank_on_any_labels(spark):
    df = spark.createDataFrame([("1", None, "z"), (None, None, None)], "a STRING, b STRING, c STRING").toDF("x.y", "x.y", "q`r")
    assert [tuple(r) for r in select_letters(df, {"p": "A", "q": "C", "r": "D"}).collect()] == [("1", "z", None), (None, None, None)]
    assert [r[0] for r in df.select(row_nonblank(df)).collect()] == [True, False]
    one = df.drop("none").select(col_at(df, "C").alias("v"))
    assert [r.v for r in one.collect()] == ["z", None]
    with pytest.raises(ValueError, match="repeats"):
        col_at(df, "A")
    resp, ans = wide_to_canonical(df, {"Q1": "A", "Q2": "C"}, {"id": "B"})
    assert resp.count() == 2 and {(r.question_id, r.score_raw) for r in ans.collect()} == {("Q1", "1"), ("Q2", "z"), ("Q1", None), ("Q2", None)}
    assert by_position(df).columns == ["c0", "c1", "c2"]


def test_five_reports_from_files_whose_headers_are_the_questions(spark):
    """All labels of the classic layout, with their dots and punctuation, in two files of another column order."""
    d = _dir()
    width = letter_to_index("IZ") + 1
    labels = [""] * width
    for letter, text in layout.QUESTION_LABELS:
        labels[letter_to_index(letter)] = text
    for letter, text in (("A", "ID"), ("E", "¿Satisfecho? 1.a"), ("GU", "Gen."), ("GV", "NPS."), ("CM", "Área.")):
        labels[letter_to_index(letter)] = text
    rows = []
    for i in range(60):
        row = [""] * width
        for letter, v in (("A", i), ("E", i % 10 + 1), ("GU", ["Gen X", "Gen Y"][i % 2]), ("GV", ["Promotores", "Pasivo", "Detractor"][i % 3]),
                          ("CM", ["Norte", "Sur", "Este"][i // 7 % 3]), *((q, i % 4 + 1) for q, _ in layout.QUESTION_LABELS)):
            row[letter_to_index(letter)] = str(v)
        rows.append(row)
    turn = [*range(width - 1, -1, -1)]
    # blank labels are told apart by their turn, so a reversed file keeps its blank columns blank
    _write(d / "a.csv", [labels, *rows[:30]])
    _write(d / "b.csv", [[labels[j] for j in turn], *[[r[j] for j in turn] for r in rows[30:]]])
    reports = sheet_reports(read_sheet(spark, str(d), ordinal=True), universe=100.0, demographics=[DemographicGroup("Área", "CM", (), {})])
    assert reports["consolidado"].first()["respuestas"] == 60
    scores = {r.question_id: r.general for r in reports["por_pregunta"].collect()}
    assert len(scores) == len(layout.QUESTION_LABELS) and len(set(scores.values())) == 1 and None not in scores.values()
    assert [(r["variable"], r["general"]) for r in reports["demografia"].orderBy("index").collect()] == [("Norte", 21), ("Sur", 21), ("Este", 18)]
    assert reports["comentarios"].count() == 60
    assert index_to_letter(width - 1) == "IZ"
