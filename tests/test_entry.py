"""Driver contract and oracle parity on the smallest scale factor."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def c(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 9))
        return repr(v)

    return sorted(tuple(c(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns[:3] == ["total_personas", "respuestas", "pct_participacion"]


def test_every_query_has_oracle_or_is_documented():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    ours = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert ours <= set(o)


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if not k.startswith("op")))
def test_oracle_parity_sf0001(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)
