"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets. Shuffle width is a starting point only: AQE
# coalesces small partitions and splits skewed ones at runtime.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_settings(input_bytes: int, total_cores: int, split_bytes: int = 256 << 20,
                   max_shuffle_partitions: int = 100_000) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet on ``total_cores``.

    * scan splits of ``split_bytes`` (compressed), so a task decodes a few
      hundred MB and the task count stays in the hundreds of thousands at 100 TB;
    * one initial shuffle partition per GB of input (at least 3 per core, at
      most ``max_shuffle_partitions``, so the map x reduce block count stays
      manageable). Shuffled data is projected and partially aggregated, so a
      partition holds well under a GB; AQE coalesces what turns out small toward
      the advisory size and splits skewed join partitions;
    * this width also bounds the number of ordered segments in ``operators.ml``
      (AQE merges adjacent small ones).

    Apply with ``spark.conf.set`` before building plans, or pass as ``extra`` to
    ``build_session``; a cluster's own settings take precedence when it has them.
    """
    parts = min(max(3 * total_cores, -(-input_bytes // (1 << 30))), max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "aerolith", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets it to shared storage and we only
    read it. Only in local mode, and only when it is unset (tests), do we create a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="aerolith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
