"""Survey table sources and report sinks.

There is no xlsx source in Spark; survey sheets are read from Parquet or
CSV (exported sheets), with every cell as text and the usual spreadsheet
"not available" tokens turned into NULL, like a spreadsheet reader does.
Reports are written as one Parquet folder per report.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .letters import quoted
from .sheets import NA_TOKENS, read_sheet


def read_survey(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
                na_tokens: Iterable[str] | None = NA_TOKENS, ordinal: bool = False, **options: str) -> DataFrame:
    """The rows of a survey sheet under their labels; ``sheets.read_sheet`` also gives positions and rejected records.

    CSV cells are STRING, and every file is read by its own header; files split over tasks unless cells hold line breaks
    (``multiLine="true"``). Text cells equal to an NA token become NULL (numeric columns of a typed source are left
    alone). ``ordinal`` adds ``row_ord``, the place of every row in the sheet.
    """
    if schema:      # a declared schema fixes names and order
        if ordinal:
            raise ValueError("a sheet is numbered by its files' own layout: leave the schema out")
        if fmt == "csv":
            options = {"header": "true", **options}
        df = spark.read.schema(schema).options(**options).format(fmt).load(path)
        cells = [F.when(~F.col(quoted(f.name)).isin(*na_tokens), F.col(quoted(f.name))).alias(f.name)
                 if na_tokens and f.dataType.simpleString() == "string" else F.col(quoted(f.name)) for f in df.schema.fields]
        return df.select(*cells)
    multi_line = str(options.pop("multiLine", "false")).lower() == "true"
    return read_sheet(spark, path, fmt, ordinal, multi_line, options.pop("sep", ","), na_tokens, **options).labelled()


def _jfs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_reports(spark: SparkSession, base: str) -> list[str]:
    """Report names (sub-folders) under a base path."""
    fs, p = _jfs(spark, base)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith("_"))


def write_report(df: DataFrame, base: str, name: str, mode: str = "keep-others",
                 drop: Iterable[str] = ()) -> str:
    """S5 + S6: write ``df`` as report ``name`` under ``base`` (replacing only that report).

    The rows go to a hidden folder first, which then takes the report's name, so nobody meets half a
    report; the old one is moved aside and removed last. ``publish.publish`` switches several reports at once.

    ``mode``: "keep-others" leaves the other reports; "only" removes every
    other report under ``base``. ``drop`` removes the named reports, but never
    the one just written (so the namespace is never left empty).
    """
    spark = df.sparkSession
    if mode not in ("keep-others", "only"):
        raise ValueError(f"unknown publish mode {mode!r}")
    target = f"{base.rstrip('/')}/{name}"
    hidden = f"{base.rstrip('/')}/_{name}-{uuid.uuid4().hex}"
    df.write.parquet(hidden)
    fs, new = _jfs(spark, hidden)
    old, aside = _jfs(spark, target)[1], _jfs(spark, f"{hidden}-old")[1]
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"cannot publish {target}")
    if had:
        fs.delete(aside, True)
    victims = set(drop)
    if mode == "only":
        victims |= set(list_reports(spark, base))
    victims.discard(name)
    for v in sorted(victims):
        fs, p = _jfs(spark, f"{base.rstrip('/')}/{v}")
        if fs.exists(p):
            fs.delete(p, True)
    return target


def read_report(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}")

