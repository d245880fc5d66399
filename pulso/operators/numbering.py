"""Running index over a total order without a task that holds all rows.

Rows are range-partitioned on the order, so the partitions follow each other and rows with equal keys share one; each
partition is sorted, and a row's number in it is written with the row. The counts of the partitions, one small row each, are
summed up, and a row's index is its number plus the rows of the partitions before its own. However many rows one group has, its rows
spread over the partitions, as the group is only the first of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOCAL = (1 << 33) - 1


def running_index(df: DataFrame, order: Sequence[Column], out: str = "index", name: str = "index") -> DataFrame:
    """Add ``out``: 0, 1, 2, ... in the order of ``order``, which should tell all rows apart (equal keys are numbered in any order).

    The rows are written twice: once so that the sample that places the ranges and the rows themselves are the same, once with their numbers.
    """
    spread = materialize(df, f"{name}-rows").repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    rows = materialize(spread.withColumns({"__part": F.shiftright(place, 33).cast("int"), "__local": place.bitwiseAND(F.lit(_LOCAL))}), f"{name}-sorted")
    parts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("__part", before.alias("__before"))      # one row per partition
    return rows.join(F.broadcast(offsets), "__part").withColumn(out, (F.col("__before") + F.col("__local")).cast("bigint")).drop("__part", "__local", "__before")
