"""Versions of reports: modes, failures between any two steps, removal of old folders."""

from __future__ import annotations

import tempfile
from pathlib import Path

import pytest

from pulso.sources import io, publish as pub


def _base() -> str:
    return tempfile.mkdtemp(prefix="pulso-versions-")


def _df(spark, n):
    return spark.createDataFrame([(n,)], "v INT")


def _all(spark, base):
    return {name: pub.published(spark, base, name).first()[0] for name in pub.manifest(spark, base)}


def test_modes_and_old_versions(spark):
    base = _base()
    assert pub.versions(spark, base) == [] and pub.manifest(spark, base) == {}
    pub.publish({"a": _df(spark, 1), "b": _df(spark, 2)}, base)
    pub.publish({"b": _df(spark, 3), "c": _df(spark, 4)}, base)
    assert _all(spark, base) == {"a": 1, "b": 3, "c": 4}
    pub.publish({"c": _df(spark, 5)}, base, drop=("a", "c"))
    assert _all(spark, base) == {"b": 3, "c": 5}
    assert pub.publish({"d": _df(spark, 6)}, base, mode="only") == 4 and _all(spark, base) == {"d": 6}
    assert pub.published(spark, base, "b", version=1).first()[0] == 2
    with pytest.raises(KeyError):
        pub.published(spark, base, "a")
    for bad in (lambda: pub.publish({}, base), lambda: pub.publish({"a": _df(spark, 1)}, base, mode="x")):
        with pytest.raises(ValueError):
            bad()
    assert pub.vacuum(spark, base, keep=2) == 3 and pub.versions(spark, base) == [3, 4]
    assert _all(spark, base) == {"d": 6} and pub.published(spark, base, "b", version=3).first()[0] == 3


@pytest.mark.parametrize("step", ["_write_rows", "_write_text", "_rename"])
@pytest.mark.parametrize("after", [False, True])
def test_a_failure_at_any_step_leaves_one_whole_set(spark, monkeypatch, step, after):
    base = _base()
    pub.publish({"a": _df(spark, 1), "b": _df(spark, 2)}, base)
    real = getattr(pub, step)

    def fail(*args):
        if after:
            real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(pub, step, fail)
    with pytest.raises(RuntimeError):
        pub.publish({"a": _df(spark, 7), "b": _df(spark, 8)}, base)
    monkeypatch.setattr(pub, step, real)
    assert _all(spark, base) == ({"a": 7, "b": 8} if step == "_rename" and after else {"a": 1, "b": 2})
    pub.publish({"b": _df(spark, 9)}, base)     # the next run goes on from there
    assert _all(spark, base)["b"] == 9
    pub.vacuum(spark, base)
    left = {str(p.parent.relative_to(base)) for p in Path(base).rglob("*.parquet")}
    assert left == set(pub.manifest(spark, base).values())


def test_a_number_is_published_once(spark, monkeypatch):
    base = _base()
    pub.publish({"a": _df(spark, 1)}, base)
    monkeypatch.setattr(pub, "versions", lambda *x: [])
    with pytest.raises(OSError):
        pub.publish({"a": _df(spark, 2)}, base)
    monkeypatch.undo()
    assert _all(spark, base) == {"a": 1}


def test_a_single_report_comes_back_if_it_cannot_be_replaced(spark, monkeypatch):
    base = _base()
    io.write_report(_df(spark, 1), base, "r")
    real = io._jfs

    class Stubborn:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, old, new):
            return False if old.getName().startswith("_") and not old.getName().endswith("-old") else self.fs.rename(old, new)

    monkeypatch.setattr(io, "_jfs", lambda s, p: (Stubborn(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError):
        io.write_report(_df(spark, 2), base, "r")
    monkeypatch.undo()
    assert io.read_report(spark, base, "r").first()[0] == 1 and io.list_reports(spark, base) == ["r"]
    io.write_report(_df(spark, 3), base, "r")
    assert io.read_report(spark, base, "r").first()[0] == 3
