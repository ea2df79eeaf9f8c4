"""Session helpers: a local session for tests and bench, and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str = "ledgerloom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for one machine. On a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="ledgerloom-", ignore_cleanup_errors=True)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local-mode session may do without the setting; it then gets a temporary folder that goes with the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder().name
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
