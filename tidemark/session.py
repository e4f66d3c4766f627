"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(app: str = "tidemark", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. A temporary folder
    takes its place only where all tasks run on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix=f"tidemark-{purpose}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
