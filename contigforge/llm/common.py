"""What the operators of this subpackage share: typed inputs, batch settings and shared storage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint, shared_dir, ship

#: Rows in one Arrow batch handed to Python; texts may be long, so batches are small.
BATCH_ROWS = 256

#: Folder of the public tokenizer files, unless a caller names another.
TOKENIZERS = None


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a public vocabulary file; each machine has its own copy of the package."""
    if folder or TOKENIZERS:
        return os.path.join(folder or TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone: other columns go, a null text becomes empty, a null id stays null."""
    return df.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with state made once for each task; make() returns the function of a batch."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for b in batches:
            if b.num_rows:
                yield one(b)

    return df.mapInArrow(run, schema)


def batch(**columns: tuple) -> pa.RecordBatch:
    """A record batch of name=(values, arrow type)."""
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in columns.values()], names=list(columns))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage ends there, and later scans prune columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files and checkpoints of frames that are gone. Spark does so when the driver's garbage is collected, for which loops of many rounds can't wait."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def make_room(spark: SparkSession, workers: bool = True) -> None:
    """Gives back what executors hold of the steps before, by a job of one small task for each core: workers forget, and a full collection lets a heap shrink that else stays as large as it ever was. What comes after takes what it needs again. workers: if not, Python workers are left alone, for steps that run none."""
    ship(spark)
    release(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("room", object)
        yield from batches

    n = max(1, spark.sparkContext.defaultParallelism)
    cores = spark.range(0, n, 1, n)
    if workers:
        cores = cores.mapInArrow(run, "id long")
    cores.select(F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("done")).write.format("noop").mode("overwrite").save()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _trim() -> None:
    """Gives freed memory back to the system, where the C library can."""
    import ctypes

    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


_held: dict = {}


def worker_state(key, make: Callable[[], object]):
    """What a worker keeps between tasks under this key. A worker keeps one thing at a time: asking for another drops what the operator before has left, as all share the executor's memory."""
    if key not in _held:
        for old in _held.values():
            if hasattr(old, "clear"):
                old.clear()
        emptied = bool(_held)
        _held.clear()
        if emptied:
            gc.collect()
            pa.default_memory_pool().release_unused()
            _trim()
        _held[key] = make()
    return _held[key]


def fresh(df: DataFrame, name: str) -> str:
    """name, with as many underscores before it as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column(name: str):
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
