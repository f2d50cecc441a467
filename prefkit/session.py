"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("prefkit")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder stands in only where nothing is set and the master is
    local; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="prefkit-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
