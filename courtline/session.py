"""Session construction and the shared scratch location.

Scratch data (landing documents, versioned tables, stream checkpoints) lives
under ``spark.checkpoint.dir`` so that on a cluster it is on the shared file
system the cluster names, never on a machine-local temporary folder.  A value
is only set here when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CHECKPOINT_FALLBACK = "/tmp/courtline-checkpoints"
# Broadcast budget for sizes that are measured or proven (not estimated).
RUNTIME_BROADCAST_BUDGET = "64MB"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "courtline", driver_memory: str | None = None) -> SparkSession:
    """Create or reuse a session with the settings the pipeline relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of collected DataFrames are removed by the cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Runtime (AQE) broadcast budget: applies to *measured* shuffle sizes
        # only; the static, estimate-based threshold keeps its default.
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", RUNTIME_BROADCAST_BUDGET)
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only if unset.

    A machine-local folder is set only for a local master; on a cluster the
    session has to name a folder that all machines share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None)
    if not target:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        target = _LOCAL_CHECKPOINT_FALLBACK
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared scratch root (``<checkpoint dir>/courtline/...``).

    The root is taken from ``spark.checkpoint.dir`` (the directory the cluster
    names for lineage cuts).  ``unique=True`` appends a fresh suffix so that a
    run never overwrites a directory another run may still be reading.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = ensure_checkpoint_dir(spark)
    root = root.rstrip("/")
    parts = list(parts)
    if unique:
        parts.append(uuid.uuid4().hex[:12])
    return "/".join([root, "courtline", *parts])


def default_blocks(spark: SparkSession) -> int:
    """Number of range blocks used by the skew-safe scans (one per shuffle partition)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to a fresh folder of the shared scratch root and return the copy.

    The copy is compressed Parquet, read column by column: a checkpoint holds
    whole uncompressed rows, and one that is computed once needs a cached copy beside it.
    Zstandard takes less room than the default, which counts as copies stay until the folder is cleaned.
    """
    path = scratch_path(df.sparkSession, "materialized", unique=True)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
