"""Contigs: length and GC, filters, and the description of an assembly."""

from __future__ import annotations

from numbers import Real

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import gc_percent


def length_gc(contigs: DataFrame) -> DataFrame:
    """(contig, gc_content, length)."""
    return contigs.select("contig", gc_percent(F.col("sequence")).alias("gc_content"), F.length("sequence").cast("int").alias("length"))


def checked_cutoff(cutoff) -> float:
    if isinstance(cutoff, bool) or not isinstance(cutoff, Real):
        raise TypeError(f"the cutoff must be a number, not {type(cutoff).__name__}")
    if cutoff <= 0:
        raise ValueError(f"the cutoff must be above 0, not {cutoff}")
    return float(cutoff)


def length_filter(contigs: DataFrame, cutoff: float = 3000) -> DataFrame:
    """Contigs of at least this length; all of them if none is."""
    kept = contigs.filter(F.length("sequence") >= checked_cutoff(cutoff))
    return kept if not kept.isEmpty() else contigs


def nx(lengths: DataFrame, quantiles: dict[str, float], by: list[str] = [], length: str = "length") -> DataFrame:  # noqa: B006
    """Of each group, the length at which lengths in falling order reach each share of their sum. Equal lengths are folded before they are ordered."""
    folded = lengths.groupBy(*by, length).agg((F.sum(length)).alias("_bases"))
    w = Window.partitionBy(*by)
    run = folded.withColumn("_cum", F.sum("_bases").over(w.orderBy(F.col(length).desc()))).withColumn("_total", F.sum("_bases").over(w))
    return run.groupBy(*by).agg(*[F.max(F.when(F.col("_cum") >= F.lit(q) * F.col("_total"), F.col(length))).alias(name) for name, q in quantiles.items()])


def describe(contigs: DataFrame) -> DataFrame:
    """One row: number, bases, longest contig (the first in name order of equals), N10, N50, N90 and length-weighted GC."""
    x = length_gc(contigs)
    one = x.agg(
        F.count("*").alias("n_contigs"), F.sum("length").cast("long").alias("size"), F.max_by("contig", F.struct("length", F.col("contig"))).alias("_"),
        F.min_by("contig", F.struct((-F.col("length")).alias("l"), "contig")).alias("largest"), (F.sum(F.col("gc_content") * F.col("length")) / F.sum("length")).alias("weighted_gc"),
    ).drop("_")
    return one.crossJoin(nx(x, {"n10": 0.1, "n50": 0.5, "n90": 0.9}))


def length_weighted_gc(contigs: DataFrame) -> DataFrame:
    return length_gc(contigs).agg((F.sum(F.col("gc_content") * F.col("length")) / F.sum("length")).alias("weighted_gc"))
