"""Summary of bins: size, markers, Nx, coverage and GC, and their taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RANKS
from .contigs import nx
from .markers import cluster_markers, reference_markers
from . import taxonomy as tax


def cluster_stats(bins: DataFrame, column: str) -> list:
    """Aggregates of a column: least, greatest, sample deviation, median and length-weighted mean."""
    return [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"), F.stddev_samp(column).alias(f"std_{column}"), F.median(column).alias(f"median_{column}"), (F.sum(F.col(column) * F.col("length")) / F.sum("length")).alias(f"length_weighted_{column}_mean")]


def metabin_stats(bins: DataFrame, markers: DataFrame) -> DataFrame:
    """24 columns for each cluster, contigs without one taken together as unclustered; floats rounded to two places, halves to even."""
    all_bins = bins.withColumn("cluster", F.coalesce("cluster", F.lit("unclustered")))
    per = cluster_markers(all_bins, markers).groupBy("cluster").agg(F.sum("n").alias("marker_sum"), F.count("*").alias("unique_markers"), F.count_if(F.col("n") == 1).alias("single_copy_markers"), F.count_if(F.col("n") > 1).alias("redundant_markers"))
    size = all_bins.groupBy("cluster").agg(F.count("*").alias("nseqs"), F.sum("length").cast("long").alias("size"), *cluster_stats(all_bins, "coverage"), *cluster_stats(all_bins, "gc_content"))
    whole = all_bins.agg(F.count("*").alias("_n"), F.sum("length").alias("_bases"))
    rows = size.join(per, "cluster", "left").join(nx(all_bins, {"n90": 0.9, "n50": 0.5, "n10": 0.1}, ["cluster"]), "cluster").crossJoin(F.broadcast(reference_markers(markers))).crossJoin(F.broadcast(whole))  # a row each
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    two = lambda c: F.rint(F.round(c, 9) * 100) / 100
    stats = [two(c).alias(c) for x in ("coverage", "gc_content") for c in (f"min_{x}", f"max_{x}", f"std_{x}", f"median_{x}", f"length_weighted_{x}_mean")]
    return rows.select(
        "cluster", "nseqs", "size", two(none("unique_markers") * 100.0 / F.nullif("expected", F.lit(0))).alias("completeness"), two(none("single_copy_markers") * 100.0 / F.nullif("unique_markers", F.lit(0))).alias("purity"),
        none("marker_sum").alias("marker_sum"), none("unique_markers").alias("unique_markers"), none("single_copy_markers").alias("single_copy_markers"), none("redundant_markers").alias("redundant_markers"), F.col("expected").alias("expected_unique_markers"),
        two(F.col("nseqs") * 100.0 / F.col("_n")).alias("percent_nseqs"), two(F.col("size") * 100.0 / F.col("_bases")).alias("percent_size"), F.col("n90").cast("long").alias("n90"), F.col("n50").cast("long").alias("n50"), F.col("n10").cast("long").alias("n10"), *stats[:4], stats[4], *stats[5:],
    )


def metabin_taxonomy(bins: DataFrame, lineages: DataFrame, tree: DataFrame) -> DataFrame:
    """The taxon of each cluster by votes of its contigs, a contig's weight being its length. A taxid counts at the lowest canonical rank of its lineage, or at the highest
    if it has none, so that strains and clades have no advance over species. bins has a taxid; lineages and tree are those of taxonomy."""
    path = tax.paths(tree)
    votes = bins.filter("cluster is not null and taxid is not null").join(tax.canonical_self(tree, path), "taxid", "left")
    rank = F.when(F.coalesce("top_rank", F.lit("root")) == "root", RANKS[-1]).otherwise(F.col("top_rank"))
    votes = votes.select(F.col("cluster").alias("contig"), rank.alias("rank"), "taxid", "length", "contig_order")
    counted = votes.groupBy("contig", "rank", "taxid").agg(F.sum("length").alias("n"), F.min("contig_order").alias("first_seen"))
    return tax.majority_vote(counted, tree, path).withColumnRenamed("contig", "cluster").join(lineages, "taxid", "left")
