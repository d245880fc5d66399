"""Survey sheets by position.

A sheet's columns are addressed by place, never by label: ``Sheet.rows`` has the columns c0, c1, ... (and ``row_ord``), the labels stand
beside them and may hold dots and backticks, repeat or be empty.

* **Headers.** The files of one sheet need not agree. Each file's header record is read on its own (one small read per file, on the driver, like
  the listing of the files); a column is found again by its label and, where labels repeat, by its turn among them. Missing columns
  are NULL, additional ones follow the known ones. Files of one layout are read as they are; otherwise every file brings its array of places
  through an equi-join on the file's name, so the plan does not grow with the layouts.
* **Malformed records** go to ``Sheet.rejects`` with file, start of the split, ordinal, reason and text: more cells than the header has, or a
  quote that does not end. Records with fewer cells are padded.
* **Ordinals.** Every record's place in the whole sheet, files by name: rows are counted per file split, the counts are summed up, and a row adds its place
  in its split. A CSV sheet is written to a stage once, so that counts and places come from the same splits; Parquet files know the place of a row. There is
  no sort of the rows and no task that sees them all.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .letters import by_position

# Cell texts a spreadsheet/pandas reader treats as missing by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
REJECTS = "file string, split_start bigint, row_ord bigint, reason string, record string"
BROADCAST_BYTES = 32 << 20      # of file names and places; beyond, files and rows are joined by shuffling
RAW, FILE, SPLIT, PLACE = "__record", "__file", "__split", "__place"


@dataclass(frozen=True)
class Sheet:
    """Rows by position, the label of every position, and the records that are no rows."""

    rows: DataFrame
    labels: tuple[str, ...]
    rejects: DataFrame

    def labelled(self) -> DataFrame:
        """The rows under their labels, which may repeat; an ordinal stays ``row_ord``."""
        return self.rows.toDF(*self.labels, *self.rows.columns[len(self.labels):])


def read_sheet(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", ordinal: bool = False, multi_line: bool = False,
               sep: str = ",", na_tokens: Iterable[str] | None = NA_TOKENS, **options: str) -> Sheet:
    """S1 + S2: the sheet in one file, a folder or several of them.

    CSV files need a header record each; ``multi_line`` lets cells (and labels) hold line breaks, at the price of one task per file. Cells are text, and
    NA tokens become NULL.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "csv":
        return _read_csv(spark, paths, ordinal, multi_line, sep, na_tokens, options)
    data = spark.read.options(**options).format(fmt).load(paths)
    labels = tuple(data.columns)
    if ordinal and fmt != "parquet":
        raise ValueError(f"rows of {fmt} files cannot be numbered")
    number = []
    if ordinal:
        data = data.select("*", F.col("_metadata.row_index"), F.col("_metadata.file_path"))
    here = by_position(data)
    if ordinal:
        place, file = here.columns[-2:]
        sizes = here.groupBy(F.col(file).alias(FILE)).agg(F.count(F.lit(1)).alias("n"))
        before = sizes.select(FILE, _sum_before("n", Window.orderBy(FILE)).alias("__before"))
        here = here.join(before, F.col(file) == F.col(FILE))
        number = [(F.col("__before") + F.col(place)).alias("row_ord")]
    cells = [_missing(here, f"c{i}", na_tokens) for i in range(len(labels))]
    return Sheet(here.select(*cells, *number), labels, spark.createDataFrame([], REJECTS))


def _sum_before(n: str, order: Window) -> Column:
    return F.coalesce(F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))


def _missing(df: DataFrame, name: str, na_tokens: Iterable[str] | None) -> Column:
    c = F.col(name)
    if not na_tokens or df.schema[name].dataType.simpleString() != "string":
        return c
    return F.when(~c.isin(*na_tokens), c).alias(name)


# --- headers ---------------------------------------------------------------------

def _header(spark: SparkSession, uri: str, sep: str, multi_line: bool, encoding: str) -> tuple[str, ...] | None:
    """The first record of a file; None for a file without one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
        read = 0

        def lines() -> Iterator[str]:
            nonlocal read
            while (line := reader.readLine()) is not None:
                if read or line.strip():
                    read += 1
                    yield line + "\n"

        record = next(csv.reader(lines(), delimiter=sep), None)
    finally:
        stream.close()
    if read > 1 and not multi_line:
        raise ValueError(f"a label of {uri} holds a line break: read the sheet with multi_line=True")
    return tuple(label.strip().removeprefix("﻿") for label in record) if record is not None else None


def reconcile(headers: Iterable[tuple[str, ...]]) -> tuple[tuple[str, ...], dict[tuple[str, ...], list[int]]]:
    """(labels of the sheet, header -> where each of its positions stands in files with that header, -1 for nowhere)."""
    known: dict[tuple[str, int], int] = {}
    names: dict[tuple[str, ...], list[tuple[str, int]]] = {}
    for header in headers:
        if header not in names:
            names[header] = [(label, header[:i].count(label)) for i, label in enumerate(header)]
            for name in names[header]:
                known.setdefault(name, len(known))
    places = {header: [dict(zip(own, range(len(own)))).get(name, -1) for name in known] for header, own in names.items()}
    return tuple(label for label, _ in known), places


# --- CSV -------------------------------------------------------------------------

def _read_csv(spark: SparkSession, paths: list[str], ordinal: bool, multi_line: bool, sep: str, na_tokens: Iterable[str] | None,
              options: dict[str, str]) -> Sheet:
    files = sorted(spark.read.text(paths).inputFiles())
    read = lambda uri: _header(spark, uri, sep, multi_line, options.get("encoding", "UTF-8"))
    with ThreadPool(16) as pool:
        headers = {uri: h for uri, h in zip(files, pool.map(read, files)) if h is not None}
    labels, places = reconcile(headers.values())
    width = max(map(len, places), default=0)
    # One column more than any header has: so every record is kept as text beside its cells, and can be told from its file's header.
    cells = [f"c{i}" for i in range(width + 1)]
    raw = (spark.read.schema(", ".join(f"{c} string" for c in [*cells, RAW])).options(**options)
           .options(header="true", sep=sep, escape='"', multiLine=str(multi_line).lower(), columnNameOfCorruptRecord=RAW, columnPruning="false")
           .csv(paths).select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT)))
    if multi_line:      # the reader takes the first line break for all records' end, which leaves half of others behind
        raw = raw.withColumns({c: F.nullif(F.rtrim(c, F.lit("\r")), F.lit("")) for c in cells})
    if ordinal:
        raw = _numbered(raw)
    if len(places) > 1:
        layouts = {header: i for i, header in enumerate(places)}
        where = spark.createDataFrame([(re.sub("^file:/+", "file:/", uri), layouts[h]) for uri, h in headers.items()], "__name string, __layout int").join(
            spark.createDataFrame([(i, len(h), places[h]) for h, i in layouts.items()], "__layout int, __own int, __at array<int>"), "__layout")
        if sum(len(uri) + 8 * len(labels) for uri in headers) < BROADCAST_BYTES:
            where = F.broadcast(where)
        raw = raw.join(where, F.regexp_replace(FILE, "^file:/+", "file:/") == F.col("__name"))
        own = F.col("__own")
        at = [F.get(F.array(*cells), F.get("__at", F.lit(i))) for i in range(len(labels))]
    else:
        own, at = F.lit(width), [F.col(c) for c in cells[:len(labels)]]
    # A text without its quoted parts has one separator less than cells; a quote that is left does not end.
    bare = F.regexp_replace(RAW, '"[^"]*+"', "")
    count = F.coalesce(F.regexp_count(bare, F.lit(re.escape(sep))) + 1, F.lit(width + 1))
    beyond = F.exists(F.slice(F.array(*cells), own + 1, width + 1), lambda c: c.isNotNull())
    reason = (F.when(F.coalesce(F.contains(bare, F.lit('"')), F.lit(False)), "quotes")
              .when((count > own) & (beyond | (count > width + 1)), "cells"))
    judged = raw.withColumn("__reason", reason)
    number = [F.col("row_ord")] if ordinal else []
    rows = judged.filter(F.col("__reason").isNull()).select(*[a.alias(f"c{i}") for i, a in enumerate(at)], *number)
    rows = rows.select(*[_missing(rows, f"c{i}", na_tokens) for i in range(len(labels))], *number)
    rejects = judged.filter(F.col("__reason").isNotNull()).select(
        F.col(FILE).alias("file"), F.col(SPLIT).alias("split_start"), (F.col("row_ord") if ordinal else F.lit(None).cast("bigint")).alias("row_ord"),
        F.col("__reason").alias("reason"), F.coalesce(RAW, F.array_join(F.array(*cells), sep)).alias("record"))
    return Sheet(rows, labels, rejects)


def _numbered(raw: DataFrame) -> DataFrame:
    """Add ``row_ord``, the place of every record in the sheet."""
    staged = materialize(raw.withColumn(PLACE, F.monotonically_increasing_id()), "sheet")
    splits = staged.groupBy(FILE, SPLIT).agg(F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("__first"))
    sizes = splits.groupBy(FILE).agg(F.sum("n").alias("__rows"))
    # one row per file, one per split
    files = sizes.select(FILE, _sum_before("__rows", Window.orderBy(FILE)).alias("__of_files"))
    before = (splits.join(files, FILE)
              .select(FILE, SPLIT, "__first", (F.col("__of_files") + _sum_before("n", Window.partitionBy(FILE).orderBy(SPLIT))).alias("__before")))
    return staged.join(before, [FILE, SPLIT]).withColumn("row_ord", F.col("__before") + F.col(PLACE) - F.col("__first")).drop(PLACE, "__first", "__before")


def write_sheet(df: DataFrame, path: str, labels: Sequence[str] | None = None, mode: str = "errorifexists", sep: str = ",") -> None:
    """Write a sheet as CSV files, each with the header record; ``labels`` may repeat. Partitions without rows have no record."""
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="").writerow(labels or df.columns)
    here = by_position(df)
    line = F.to_csv(F.struct(*here.columns), {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    here.select(F.when(first, F.concat(F.lit(out.getvalue() + "\n"), line)).otherwise(line).alias("value")).write.mode(mode).text(path)
