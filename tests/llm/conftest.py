from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs with columns whose names clash with working columns."""

    def make(rows, extra="fp long, found string, score double, block string, cell int, n long"):
        fields = [f.split() for f in extra.split(", ")]
        schema = "doc_id long, text string, " + extra
        return spark.createDataFrame([(i, t, *[None] * len(fields)) for i, t in rows], schema)

    return make
