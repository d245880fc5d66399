"""Incremental KPI row over arriving survey responses.

Responses land as files; the raw-spelling cuboid (the same pre-aggregate the
batch KPI plan uses) is kept as streaming state in complete mode. Its size is
bounded by the number of distinct (cohort, NPS) spellings, not by the number
of responses, so each micro-batch re-derives the KPI metrics from a small
table inside ``foreachBatch`` and publishes them idempotently (overwrite per
epoch). State and progress live in a checkpoint under the shared folder named
by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import exact
from ..functions.numeric import pct, to_number
from ..operators.segments import with_segments
from ..plans import kpis
from ..session import ensure_checkpoint_dir
from ..sources.dims import COHORT_KEYS, COHORT_SLUG


def raw_cube_stream(responses: DataFrame, cohort_col: str = "cohort_raw", nps_col: str = "nps_raw",
                    satisfaction_col: str | None = "satisfaction_raw") -> DataFrame:
    """Streaming aggregate: (cohort_raw, nps_raw) -> n, the exact sum of the satisfaction, sat_cnt."""
    v = to_number(F.col(satisfaction_col)) if satisfaction_col else F.lit(None).cast("double")
    return (responses.groupBy(F.col(cohort_col).alias("cohort_raw"), F.col(nps_col).alias("nps_raw"))
            .agg(F.count(F.lit(1)).alias("n"), *exact.sums(v, "sat"), F.count(v).alias("sat_cnt")))


def fold_cube(raw_cube: DataFrame) -> DataFrame:
    """Classify the spellings of a raw cube and fold them into the KPI cube shape."""
    seg = with_segments(raw_cube, "cohort_raw", "nps_raw")
    return seg.groupBy("cohort", "nps_class", "responded").agg(
        F.sum("n").alias("n"), *exact.add_up("sat"), F.sum("sat_cnt").alias("sat_cnt"),
        *exact.no_sums("cond"), F.lit(0).cast("bigint").alias("cond_cnt"))


def kpi_metrics(raw_cube: DataFrame) -> DataFrame:
    """One row: responses, NPS (+ counts), class shares and satisfaction by cohort — a single
    aggregate over the folded cube."""
    cube = fold_cube(raw_cube)
    valid = kpis._n_where(F.col("nps_class").isin(*kpis._VALID_NPS))
    cols = [kpis._n_where(F.col("responded")).alias("responses"), *kpis._nps_cols()]
    cols += [pct(kpis._n_where(F.col("nps_class") == k), valid).alias(f"pct_{k}")
             for k in ("promoter", "passive", "detractor")]
    cols += [kpis._mean("sat").alias("satisfaction_general")]
    cols += [kpis._mean("sat", F.col("cohort") == k).alias(f"satisfaction_{COHORT_SLUG[k]}") for k in COHORT_KEYS]
    return cube.agg(*cols)


def start_kpi_stream(responses: DataFrame, publish: Callable[[DataFrame, int], None],
                     checkpoint: str | None = None, trigger_once: bool = False,
                     **cols: str) -> StreamingQuery:
    """Start the incremental KPI query; ``publish(metrics_df, epoch_id)`` receives one row per batch."""
    spark = responses.sparkSession
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip("/")}/pulso-stream-kpis-{uuid.uuid4().hex}"
    raw = raw_cube_stream(responses, **cols)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        publish(kpi_metrics(batch), epoch_id)

    writer = raw.writeStream.outputMode("complete").option("checkpointLocation", ckpt).foreachBatch(on_batch)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
