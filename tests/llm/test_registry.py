from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from pulso.llm import registry

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(registry.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle_parity(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    res = duck.execute(registry.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    canon = lambda rows: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert canon(tuple(r[c] for c in cols) for r in df.collect()) == canon(res.fetchall())


def test_llm_package_is_used_by_nothing_else():
    from pathlib import Path

    root = Path(entry.__file__).parent
    for p in [*root.glob("pulso/*.py"), *root.glob("pulso/[!l]*/*.py"), *root.glob("tools/*.py"), root / "bench.py"]:
        assert not re.search(r"\bllm\b", p.read_text()), p
