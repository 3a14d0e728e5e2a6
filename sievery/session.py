"""Session settings and shared storage locations.

The library never creates a session behind the caller's back: every public
function takes the ``SparkSession`` (or a DataFrame) it should run on.  This
module only offers a builder for scripts and tests, and the one place where
the shared checkpoint folder is resolved.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every job in this package.  AQE coalesces the
# shuffle partitions of small stages and splits skewed join partitions at run
# time; UTC keeps event-time windows independent of the machine's zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # of a repeated key in a raw message the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    # checkpoints written by the row index are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions: enough for ``target_partition_bytes`` per reducer
    (the notable messages and their JSON are of the order of the input),
    and at least three waves of the cluster's cores; AQE then coalesces
    small partitions and splits skewed join partitions at run time.  File
    splits stay at 128 MB (``maxPartitionBytes``), which bounds the rows a
    scan task holds.
    """
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(3 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 ** 2),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "sievery", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (falls back to the shuffle partition count
    where the SparkContext is not reachable, e.g. over Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and replay-safe outputs.

    A cluster names it in ``spark.checkpoint.dir``; that value always wins.
    Only when it is unset, and the master is local (tests), is a scratch
    folder created and registered, so later calls in the same session agree on
    it; on a cluster an unset folder is an error, since each executor would
    write to its own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sievery-ckpt-")
        sc.setCheckpointDir(configured)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into a fresh folder below the shared checkpoint root and
    read back: later steps see the same rows, also after a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
