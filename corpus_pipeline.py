"""A corpus pipeline of five stages; each works on all rows that the stage before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigforge.llm import chunks, linededup, packing, quality, simhash, suffixes
from contigforge.llm.common import BATCH_ROWS, make_room, shared_dir, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now."""
    return df.select("doc_id", "text", "lang", "source", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"))


def _ready(spark: SparkSession, workers: bool = True) -> None:
    """Each stage begins with executors that hold little of the one before."""
    make_room(spark, workers)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; labellers and scorer are estimated on these documents."""
    _ready(spark)
    docs = docs.select(*COLUMNS)
    return quality.keep_good(docs, quality.fit(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without boilerplate lines, but for the first document that has one; a document of such lines alone stays, empty."""
    _ready(spark, workers=False)  # this stage is native
    return _documents(linededup.remove_lines(docs.select(*COLUMNS)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id, and of rows with one id that of the least text hash. Groups without any id keep their different texts."""
    _ready(spark)
    docs = docs.select(*COLUMNS)
    found = simhash.near_copies(docs).filter("doc_id <=> component_id")
    key = [F.coalesce("doc_id", F.lit(0)).alias("_k"), F.col("doc_id").isNull().alias("_none")]
    firsts = found.groupBy(*key, F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("_own")).agg(F.min("text_hash").alias("_hash")).drop("_own")
    keyed = docs.select("*", *key, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    kept = keyed.join(firsts, ["_k", "_none", "_hash"], "left_semi").dropDuplicates(["_k", "_none", "_hash"])  # one exchange of the texts serves both
    return kept.select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of suffixes.LENGTH bytes or more that a document of smaller id has; emptied documents stay, empty."""
    _ready(spark)
    return _documents(suffixes.remove_repeats(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences that hold the sources in proportion."""
    _ready(spark)
    return packing.pack(docs.select(*COLUMNS), tokenizer_path("byte_bpe_50k.json"), memory=chunks.SHARED_MEMORY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet into the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{i}")
    return docs


#: Fitting a classifier, SimHash and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
