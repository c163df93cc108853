"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on: AQE re-plans joins and partition counts at
# runtime, skew-join splitting protects against one hot user or item, and all
# timestamps are read in UTC so the DuckDB oracle sees the same values.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "cadenza", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, creating a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only on a local master, and when neither that setting nor a context checkpoint dir
    exists (tests), is a fresh folder under the system temp dir created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cadenza-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured) if _settable(spark) else None
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _settable(spark: SparkSession) -> bool:
    try:
        return spark.conf.isModifiable("spark.checkpoint.dir")
    except Exception:
        return False


def reliable_checkpoint(df):
    """Eager reliable checkpoint into the session's checkpoint folder (never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_unused(spark) -> None:
    """Let Spark delete the shuffle files, blocks and checkpoints of data that nothing refers to any more. It does so after a
    garbage collection of the driver's JVM, and a driver that only sequences jobs may not have one before the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sizing_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the input: enough shuffle partitions that each holds about
    ``target_partition_bytes`` before AQE coalesces small ones, scan splits of the
    same size, and at least two tasks per core.

    For 100 TB on 1,000 executors x 8 cores this gives ~400,000 initial shuffle
    partitions (AQE merges them down to the advisory size at run time).
    """
    parts = max(2 * executor_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    }
