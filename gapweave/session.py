"""Session helpers."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster the session comes from ``spark-submit``; adaptive execution is
    the only setting of this list that matters there.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gapweave")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="gapweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # staged copies go with the process
    return folder


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder, so a lost executor costs little."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark).rstrip('/')}/checkpoints")


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
