"""Largest-remainder apportionment.

Shares of a partition are scaled to ``units`` integer units that add up
exactly: every row gets floor(w * units / total); the ``need`` =
units - sum(floors) rows with the largest remainders get one more unit
(ties -> ``tie_cols`` ascending). Integer arithmetic throughout, so the
result does not depend on float noise.

Totals are grouped aggregates of one row per partition. ``need`` is below
``units``, so the rows that can get a unit are among the first ``units`` of
every salted part of a partition: those few are ranked, the last one that gets a
unit is the partition's cut, and every row compares itself with the cut. No
task ever holds a whole partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SALTS = 64


def apportion(df: DataFrame, partition_cols: Sequence[str], weight_col: str, units: int,
              tie_cols: Sequence[str], out_col: str) -> DataFrame:
    """Add ``out_col`` = apportioned units / ``units`` (DOUBLE); NULL where the partition total is <= 0."""
    parts, place = list(partition_cols), F.struct(*[F.col(c) for c in tie_cols])
    # 28 digits: room for any BIGINT weight times any units, and for sums of them
    weighed = df.withColumn("__w", F.col(weight_col).cast("bigint").cast("decimal(28,0)"))
    totals = weighed.groupBy(*parts).agg(F.sum("__w").alias("__tot"))
    shared = (weighed.join(totals, parts)
              .withColumn("__floor", F.when(F.col("__tot") > 0, F.expr(f"(__w * {int(units)}BD) div __tot")))
              .withColumn("__key", F.when(F.col("__tot") > 0, F.struct((-F.expr(f"(__w * {int(units)}BD) % __tot")).alias("r"), place.alias("p")))))
    # Three branches below read these rows.
    shared = materialize(shared, "apportion")
    need = shared.groupBy(*parts).agg((F.lit(units) - F.sum("__floor")).alias("__need"))
    salted = shared.filter(F.col("__key").isNotNull()).select(*parts, "__key", F.pmod(F.xxhash64(*tie_cols), F.lit(SALTS)).alias("__salt"))
    first = F.row_number().over(Window.partitionBy(*parts, "__salt").orderBy("__key"))
    few = salted.withColumn("__rn", first).filter(F.col("__rn") <= units).drop("__rn")
    ranked = few.withColumn("__rank", F.row_number().over(Window.partitionBy(*parts).orderBy("__key")))
    cut = (ranked.join(need, parts).filter(F.col("__rank") == F.col("__need"))
           .select(*parts, F.col("__key").alias("__cut")))
    bump = F.coalesce(F.col("__key") <= F.col("__cut"), F.lit(False)).cast("int")
    value = F.when(F.col("__tot") > 0, (F.col("__floor") + bump) / F.lit(float(units)))
    return shared.join(cut, parts, "left").withColumn(out_col, value).drop("__w", "__tot", "__floor", "__key", "__cut")
