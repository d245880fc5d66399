"""SparkSession defaults for survey reports.

Only settings that are unset are filled in, so a cluster's own configuration
(shuffle partitions, checkpoint folder, broadcast threshold) always wins.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied when the session does not define them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Folders of intermediate tables written by this process.
_STAGES: list[str] = []


def get_session(master: str | None = None, app_name: str = "pulso", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the report defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(sc) -> bool:
    return sc.master.startswith("local") and not sc.master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is. When
    it is unset, a local master gets a private scratch folder (tests); any other
    master raises, because a machine-local folder is invisible to other machines.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (e.g. remote clients)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not _is_local(sc):
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="pulso-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table; removed by ``release_stages`` or at interpreter exit."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pulso-stage/{name}-{uuid.uuid4().hex}"
    if not _STAGES:
        atexit.register(_release_at_exit)
    _STAGES.append(path)
    return path


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of an intermediate that several branches of a plan read,
    so the expensive input is scanned once, and a lost executor only recomputes
    from the written table. The folder is the one named by
    ``spark.checkpoint.dir`` (shared storage on a cluster).
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_stages(spark: SparkSession) -> int:
    """Delete every intermediate table written so far; call it once their results are consumed."""
    sc = spark.sparkContext
    conf, n = sc._jsc.hadoopConfiguration(), 0
    while _STAGES:
        p = sc._jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            release_stages(spark)
        except Exception:  # the JVM may be gone already
            pass
