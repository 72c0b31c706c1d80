"""Spark session settings for the rates engine.

Correctness does not depend on these settings (every expression pins its own
null order, formats and types); they are the physical defaults the plans are
tuned for: UTC session time, ANSI casts, AQE with skew-join splitting and
partition coalescing, dynamic partition overwrite for period-replacing sinks.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keep small-but-CPU-heavy stages (HTML tokenising, JSON parsing) spread over
    # the cores; large inputs still coalesce to the advisory partition size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Long-running sessions: keep less job / stage / execution history on the driver.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "ratebridge",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local or cluster session with the engine's defaults.

    On a cluster, ``shuffle_partitions`` should be sized so one shuffle
    partition is ~128-256 MB at the target scale; AQE then coalesces small ones.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``. Only on a single machine
    (master ``local``), where a temporary folder is shared by all tasks, an unset
    folder is made and registered; elsewhere that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ratebridge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc = spark.sparkContext
    # Each setCheckpointDir call makes a new sub-folder; set it only once.
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def cluster_conf(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 << 20,
) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Scans split files into ``target_partition_bytes`` pieces; the initial
    shuffle partition count lets the largest shuffle (at most the input size
    here: the models project and pre-aggregate before shuffling) land at about
    the target size per partition, and never below two waves of the cluster's
    cores; AQE then coalesces small partitions to the same target and splits
    skewed ones in joins. E.g. 100 TB on 1000 x 8 cores -> 409,600 partitions
    of ~256 MB.
    """
    cores = executors * cores_per_executor
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
