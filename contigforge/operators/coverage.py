"""Coverage of contigs from their names, a table, or a histogram of depths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequences import header_coverage
from ..sources import readers


def from_names(contigs: DataFrame) -> DataFrame:
    return contigs.select("contig", header_coverage(F.col("contig")).alias("coverage"))


def from_depths(depths: DataFrame) -> DataFrame:
    """(contig, coverage) of rows (contig, depth, bases, length)."""
    return depths.filter("contig <> 'genome'").groupBy("contig").agg((F.sum(F.col("depth") * F.col("bases")) / F.max("length")).alias("coverage"))


def get(spark: SparkSession, contigs: DataFrame, from_spades: bool = False, table: str | None = None, bed: str | None = None, bam: str | None = None, sam: str | None = None, reads: str | None = None) -> DataFrame:
    """From the furthest source there is: the names if asked for, a finished table, a depth histogram. Alignments and reads need an aligner and raise."""
    if from_spades:
        return from_names(contigs)
    if table:
        return readers.tsv(spark, table, "contig string, coverage double")
    if bed:
        return readers.bed_coverage(spark, bed)
    if bam or sam or reads:
        raise NotImplementedError("alignments and reads need an external aligner; give its depth histogram as bed")
    raise ValueError("no source of coverage was given")
