"""SparkSession and checkpoint-directory helpers."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_FALLBACK: str | None = None


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quarry") -> SparkSession:
    """Return the active session, or build one suited to corpus jobs.

    AQE stays on so shuffle partitions coalesce and skewed joins split at run
    time; the UI is off (no server ports)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is also the executor, so its heap is the
        # only memory knob (taken from QUARRY_DRIVER_MEMORY, default 16g)
        conf["spark.driver.memory"] = os.environ.get("QUARRY_DRIVER_MEMORY", "16g")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``; that setting wins. Only a
    local-mode session without it (tests) gets a private temporary folder;
    on a cluster the setting is required, because a machine-local folder is not
    visible to other executors."""
    global _LOCAL_CHECKPOINT_FALLBACK
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    already = sc.getCheckpointDir()
    if configured:
        path = configured
    elif already:
        # set with setCheckpointDir; Spark appends a folder of its own
        path = already.rstrip("/").rsplit("/", 1)[0]
    elif sc.master.startswith("local"):
        if _LOCAL_CHECKPOINT_FALLBACK is None:
            _LOCAL_CHECKPOINT_FALLBACK = tempfile.mkdtemp(prefix="quarry-ckpt-")
        path = _LOCAL_CHECKPOINT_FALLBACK
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                           "before running iterative corpus jobs on a cluster")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def fix_splits(spark: SparkSession) -> None:
    """Keep the splits of files the same from one scan to the next: for small
    inputs Spark derives their size from the number of cores at hand, which may
    change while a job runs, unless ``spark.sql.files.minPartitionNum`` is set."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs run inside; the former one, or none, holds again afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for staged tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "quarry-staging", f"{name}-{uuid.uuid4().hex[:12]}")


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs whose results are written go now, not when the driver
    happens to collect its garbage (twice: what the first collection frees holds some of them)."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
