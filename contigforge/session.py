"""Session helpers shared by the whole engine."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_contigforge_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="contigforge-"), "contigforge.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    sc._contigforge_shipped = True


def get_session(name: str = "contigforge") -> SparkSession:
    """A session with the settings that the engine expects; an existing one is returned as it is."""
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir, or where that is unset and all run in one process (tests) one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(folder := tempfile.mkdtemp(prefix="checkpoints-"))
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """df written to the shared folder; loops call this each round, so that plans stay short and lost executors cost one round."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, by: str) -> DataFrame:
    """df dealt by a column for kernels whose work is large where their rows are few: adaptive execution would put such groups into one task."""
    return df.repartition(max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), by)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """What runs inside sends at most so many rows at once to Python: for rows with long lists, whose buffers count in an executor's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
