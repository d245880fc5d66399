"""Respondent segments and row filters.

Each classifier is computed once per row as a projection (``cohort``,
``nps_class``, ``responded``), so every later aggregate reads a plain column
instead of re-normalising labels per metric.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import answered_label, answered_raw, norm_label, norm_label_loose, plain_label
from ..sources.dims import COHORT_VARIANTS, NPS_VARIANTS
from ..sources.letters import quoted


def classify_normalised(norm: Column, vocab: Mapping[str, Iterable[str]], loose: bool = False) -> Column:
    """First class whose (normalised) spellings contain ``norm``, else NULL."""
    expr = None
    for key, variants in vocab.items():
        cond = norm.isin(*sorted({plain_label(v, loose) for v in variants}))
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr if expr is not None else F.lit(None).cast("string")


def with_segments(df: DataFrame, cohort_col: str | None = "cohort_raw", nps_col: str | None = "nps_raw",
                  response_col: str | None = None, loose: bool = False) -> DataFrame:
    """Add ``cohort``, ``nps_class`` and ``responded`` columns.

    ``responded`` follows F2a on ``response_col`` (default: the NPS column);
    with neither column it is F3 (any non-null cell in the row). Each label is
    normalised once into a helper column, so the CASE branches compare a
    plain column instead of repeating the normaliser.
    """
    out = df
    has_c = cohort_col is not None and cohort_col in df.columns
    has_n = nps_col is not None and nps_col in df.columns
    normf = norm_label_loose if loose else norm_label
    if has_c:
        out = out.withColumn("__cn", normf(F.col(cohort_col)))
    if has_n:
        out = out.withColumn("__nn", normf(F.col(nps_col)))
    out = out.withColumn("cohort", classify_normalised(F.col("__cn"), COHORT_VARIANTS, loose) if has_c
                         else F.lit(None).cast("string"))
    if has_n:
        known = classify_normalised(F.col("__nn"), NPS_VARIANTS, loose)
        out = out.withColumn("nps_class", F.coalesce(
            known, F.when(answered_label(F.col(nps_col)), F.lit("unknown")).otherwise(F.lit("empty"))))
    else:
        out = out.withColumn("nps_class", F.lit("empty"))
    rc = response_col or nps_col
    out = out.withColumn("responded", answered_raw(rc) if rc is not None and rc in df.columns
                         else row_nonblank(df))
    return out.drop(*[c for c in ("__cn", "__nn") if c in out.columns])


def row_nonblank(df: DataFrame, columns: list[str] | None = None) -> Column:
    """the row has at least one non-null cell. Where labels repeat, the cells have to be of one type."""
    from functools import reduce

    cols = columns or df.columns
    if len(set(cols)) < len(cols):
        return F.expr("coalesce(*)").isNotNull()
    return reduce(lambda a, b: a | b, [F.col(quoted(c)).isNotNull() for c in cols], F.lit(False))


# --- F1: ID filter ------------------------------------------------------------

def _integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))


BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _canonical_ints(ids: Iterable, data_type: T.DataType) -> list[int]:
    """The ids that print back unchanged as integers of the type; no other text can equal an id of that type."""
    texts = {str(x).strip() for x in ids}
    top = 1 << BITS[type(data_type)] - 1
    return sorted(n for x in texts if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", x) and -top <= (n := int(x)) < top)


def filter_ids(df: DataFrame, ids: Iterable | None, id_col: str = "id") -> DataFrame:
    """keep rows whose trimmed, stringified id is in ``ids``; no ids = no filter.

    An integral id column is compared natively, so Parquet gets the filter;
    other types compare trimmed strings.
    """
    if not ids:
        return df
    kind = df.schema[id_col].dataType
    if _integral(kind):
        return df.filter(F.col(id_col).isin([F.lit(n).cast(kind) for n in _canonical_ints(ids, kind)]))
    wanted = sorted({str(x).strip() for x in ids})
    return df.filter(F.trim(F.col(id_col).cast("string")).isin(wanted))


def filter_ids_table(df: DataFrame, ids: DataFrame, id_col: str = "id", ids_col: str = "id") -> DataFrame:
    """F1 with the id list as a table: a left-semi join, natively where both ids are integral.

    The list can be as large as the data; Catalyst broadcasts it only when its
    estimated size is under the broadcast threshold, otherwise it shuffles.
    """
    native = _integral(df.schema[id_col].dataType) and _integral(ids.schema[ids_col].dataType)
    key = (lambda c: c.cast("bigint")) if native else (lambda c: F.trim(c.cast("string")))
    keys = ids.select(key(F.col(ids_col)).alias("__id"))
    return df.join(keys, key(df[id_col]) == keys["__id"], "left_semi")
