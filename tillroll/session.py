"""Session settings this library is written for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every column expression makes building large plans several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A one-machine session for tests and timing; a cluster brings its own. ``settings`` use __ for the dots."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tillroll")
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, and where that is unset a folder in the
    session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tillroll-shared"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; reruns never meet the files of an earlier run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
