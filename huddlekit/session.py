"""Session helpers: build a local session for tests/bench and find the shared
checkpoint folder on a cluster session."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. UTC so date/timestamp parsing is stable,
# AQE so small shuffles are coalesced, skewed joins are split and small join
# sides are broadcast only after their runtime size was measured.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # loads of several tables run side by side, one scheduler pool each
    "spark.scheduler.mode": "FAIR",
    "spark.sql.ui.retainedExecutions": "5",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "huddlekit") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("HUDDLEKIT_DRIVER_MEMORY", "8g")))
    if os.environ.get("HUDDLEKIT_WAREHOUSE"):
        builder = builder.config("spark.sql.warehouse.dir", os.environ["HUDDLEKIT_WAREHOUSE"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator and is read from the
    session; only when it is unset in local mode (tests) a scratch folder is
    made. Off local mode an unset folder is an error: a machine-local one
    would not be seen by the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="huddlekit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark resolves it; a missing one is fine."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def temporary_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder that is removed when
    the application ends, for results that outlive the call that made them."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cluster_settings(input_bytes: int, cores: int, *, target_partition_bytes: int = 128 << 20) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    The initial shuffle width gives every reducer about one target-sized
    slice of the input, and at least three waves of the cores; AQE then coalesces small partitions back toward the advisory
    size and splits skewed ones, so a stage neither spills from oversized
    partitions nor pays for many empty ones. Apply with ``spark.conf.set``
    before building the plans.
    """
    width = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
