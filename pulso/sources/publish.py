"""Publishing the reports of one run together.

A run's reports are one version: their rows are written first, each report in a folder of its own that no reader looks into yet; then a manifest that names the folder
of every report of the version is written aside and renamed to its number. That rename alone publishes the version: readers follow the manifest with the highest number,
so they see all of the old set or all of the new one, and a run that fails at any step leaves the old set as it was. Modes work on the manifest:
"keep-others" carries the other reports over, "only" does not, and ``drop`` leaves reports out, though never one that was just written. Folders that no
kept version names are removed by ``vacuum``. One publisher writes a base folder at a time; a second one that took the same number fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

MANIFESTS, DATA = "_manifests", "_versions"


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the storage that holds ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, base: str) -> list[int]:
    """The numbers of all published versions, ascending."""
    names = (n.removesuffix(".json") for n in _names(spark, f"{base.rstrip('/')}/{MANIFESTS}") if n.endswith(".json"))
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, base: str, version: int | None = None) -> dict[str, str]:
    """Report name -> folder below ``base`` of a version, by default the last; empty before the first."""
    if version is None:
        version = max(versions(spark, base), default=0)
    if not version:
        return {}
    rows = spark.read.text(f"{base.rstrip('/')}/{MANIFESTS}/{version:010d}.json", wholetext=True).collect()     # one small file
    return json.loads(rows[0][0])


def _write_rows(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    target = _fs(spark, new)[1]
    if fs.exists(target) or not fs.rename(p, target):
        raise OSError(f"cannot publish {new}")


def publish(reports: Mapping[str, DataFrame], base: str, mode: str = "keep-others", drop: Iterable[str] = ()) -> int:
    """Publish the reports as one version; its number."""
    if mode not in ("keep-others", "only"):
        raise ValueError(f"unknown publish mode {mode!r}")
    if not reports:
        raise ValueError("a version needs a report")
    base = base.rstrip("/")
    spark = next(iter(reports.values())).sparkSession
    version = max(versions(spark, base), default=0) + 1
    run = f"{DATA}/{version:010d}-{uuid.uuid4().hex}"
    for name, df in reports.items():
        _write_rows(df, f"{base}/{run}/{name}")
    gone = set(drop)
    kept = {n: path for n, path in manifest(spark, base).items() if n not in gone} if mode == "keep-others" else {}
    kept |= {name: f"{run}/{name}" for name in reports}
    aside = f"{base}/{MANIFESTS}/.{version:010d}-{uuid.uuid4().hex}"
    _write_text(spark, aside, json.dumps(kept, sort_keys=True))
    _rename(spark, aside, f"{base}/{MANIFESTS}/{version:010d}.json")
    return version


def published(spark: SparkSession, base: str, name: str, version: int | None = None) -> DataFrame:
    """A report of a version, by default the last."""
    folder = manifest(spark, base, version).get(name)
    if folder is None:
        raise KeyError(f"no report {name!r} in {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/{folder}")


def vacuum(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Remove all but the last ``keep`` versions, and folders of runs that were never published; how many folders went."""
    base = base.rstrip("/")
    known = versions(spark, base)
    for old in known[:-keep]:
        fs, p = _fs(spark, f"{base}/{MANIFESTS}/{old:010d}.json")
        fs.delete(p, False)
    used = {path for v in known[-keep:] for path in manifest(spark, base, v).values()}
    n = 0
    for run in _names(spark, f"{base}/{DATA}"):
        for name in _names(spark, f"{base}/{DATA}/{run}"):
            if f"{DATA}/{run}/{name}" not in used:
                fs, p = _fs(spark, f"{base}/{DATA}/{run}/{name}")
                fs.delete(p, True)
                n += 1
        if not _names(spark, f"{base}/{DATA}/{run}"):
            fs, p = _fs(spark, f"{base}/{DATA}/{run}")
            fs.delete(p, True)
    return n
