"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from quayside.errors import ConfigError

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Capturing a Python call site for every column expression costs more than small plans do.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches on one machine. On a cluster, pass your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("quayside")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session without the setting gets a folder of its own; on a cluster a folder of the
    driver's machine would be of no use, so there the setting is asked for.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unique folder path below the shared folder. Nothing is created yet."""
    return f"{shared_folder(spark)}/quayside-{name}-{uuid.uuid4().hex}"
