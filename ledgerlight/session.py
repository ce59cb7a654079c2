"""Spark session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps in the test
# tables are TIMESTAMP_NTZ and the reference works in one zone), adaptive
# execution for runtime coalescing and skew splitting, no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for large inputs (1000 executors): 256 MB input splits and
# shuffle partitions, 40,000 initial shuffle partitions (10 TB in one shuffle, which is
# what a projected or partially aggregated 100 TB input needs) that AQE coalesces to
# the advisory size, and skew splitting for partitions 5x the median.  A
# third of the rows under one key then becomes many ~256 MB tasks instead
# of one huge one.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlight", extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    ``shuffle_partitions`` should be sized so one partition fits an executor
    core's memory (about 128-256 MB of shuffle data each); AQE coalesces
    the small ones at runtime.  ``cluster=True`` applies ``CLUSTER_CONF``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLIGHT_DRIVER_MEMORY", "8g"))
    for k, v in {**BASE_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables, resolved once per context.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS / object store) folder.  Spark
    registers it with the context at start and appends a unique subfolder, which is used as is
    and never registered again.  Where the setting is missing, a fresh local folder is made --
    on a ``local`` master only; on any other master each executor would write to its own disk,
    so a missing setting raises ``RuntimeError`` there.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base:
        return base
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        require_local_master(sc.master)
        base = tempfile.mkdtemp(prefix="ledgerlight-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def require_local_master(master: str) -> None:
    """Raise unless driver and executors share one machine's disk (``local`` or ``local[n]``)."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(
            f"spark.checkpoint.dir is not set and the master is {master!r}: intermediate tables "
            "need a folder that the driver and all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table made at a :func:`scratch_path`; other paths are refused."""
    if "/scratch/" not in path:
        raise ValueError(f"{path} is not a scratch path")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
