"""SparkSession factory and session-level settings shared by every job.

All settings are plain Spark configuration: UTC session time zone (the reference's
timestamps are UTC instants), ANSI mode, adaptive query execution with partition
coalescing and skew-join splitting, and string-typed partition columns so a
``date=20170701`` directory stays the string shard suffix.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not tuning knobs).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Execution settings: AQE re-plans joins/partition counts from runtime sizes and
# splits skewed join partitions; the UI server stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory partition size rather than keeping many tiny tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def get_spark(master: str | None = None, app_name: str = "journeyline",
              shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**DEFAULT_CONF, **REQUIRED_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session built elsewhere."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting is given and is used as is. Only when it is unset on a local
    master (local runs, tests) a fresh scratch folder is created and registered; a cluster
    without the setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
    local = tempfile.mkdtemp(prefix="journeyline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def size_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
                  max_partitions: int = 200_000) -> dict[str, str]:
    """Shuffle sizing for an input of ``input_bytes``: about one shuffle partition per
    ``target_partition_bytes`` of input (adaptive execution coalesces what ends up small),
    the same advisory size for coalescing and skew splitting, 128 MB scan splits."""
    parts = max(8, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }
