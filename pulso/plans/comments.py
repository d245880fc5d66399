"""Comment extract (P3 + F1): a fixed 9-column projection, no row dropped.

Pure projection — a single narrow stage with column pruning at the scan;
rows with blank comments are kept, absent source columns become ''.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.segments import filter_ids, filter_ids_table

# Output columns of the comment extract, in order.
COMMENT_COLUMNS = ("id", "variable_1", "variable_2", "variable_3", "tipo_nps", "generacion", "antiguedad",
                   "tipo_contrato", "comentarios")


def comments_projection(df: DataFrame, sources: Mapping[str, str | None], ids: Iterable | None = None,
                        ids_table: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """Project ``sources`` (output column -> source column or None) in COMMENT_COLUMNS order.

    Every value is rendered as STRING; an absent source gives ''. ``ids``
    (literal list) or ``ids_table`` (a table of ids, semi-joined) filter rows.
    """
    src_id = sources.get("id") or id_col
    if ids:
        df = filter_ids(df, ids, src_id)
    if ids_table is not None:
        df = filter_ids_table(df, ids_table, src_id, ids_table.columns[0])
    cols = []
    for name in COMMENT_COLUMNS:
        src = sources.get(name)
        c = F.col(src).cast("string") if src and src in df.columns else F.lit("")
        cols.append(c.alias(name))
    return df.select(*cols)

