"""SparkSession construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the engine wants. Partition counts are sized for the
# local test box; on a cluster the deploy config overrides them (getOrCreate keeps
# settings that are already present).
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Remove reliable-checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dimension-sized sides are broadcast by the planner only below this size;
    # AQE re-checks with runtime sizes, so a side that grows falls back to a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "quantleaf",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster it comes from ``spark.checkpoint.dir`` (a shared file system
    every executor can reach). Only in local mode, where driver and executors are
    one process, is a scratch folder created when the setting is absent.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quantleaf-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        sc = spark.sparkContext
    except Exception:      # a Spark Connect session: the server uses the conf setting
        return path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` into the shared checkpoint folder (never a local
    one, never ``localCheckpoint``): cuts the lineage so later branches read it back."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), name)
