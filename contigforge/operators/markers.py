"""Marker genes and bin quality: counts, completeness, purity and spread, and their filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("completeness", "purity", "coverage_stddev", "gc_content_stddev")


def apply_cutoffs(hits: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Marker hits whose score is above the marker's cutoff; a version after a dot of the accession does not count. cutoffs: a row for each marker profile."""
    bare = lambda c: F.substring_index(c, ".", 1)
    limits = cutoffs.select(bare(F.col("accession")).alias("_acc"), "cutoff")
    return hits.join(limits, bare(F.col("sacc")) == F.col("_acc")).filter("score > cutoff").drop("_acc", "cutoff")


def marker_counts(markers: DataFrame) -> DataFrame:
    """(contig, sacc, n)."""
    return markers.groupBy("contig", "sacc").agg(F.count("*").alias("n"))


def markers_wide(markers: DataFrame, names: list[str] | None = None) -> DataFrame:
    """A column for each marker, null where none. names fixes the columns; otherwise they are looked up."""
    return markers.groupBy("contig").pivot("sacc", names).count() if names else markers.groupBy("contig").pivot("sacc").count()


def markers_list(markers: DataFrame) -> DataFrame:
    return markers.groupBy("contig").agg(F.array_sort(F.collect_list("sacc")).alias("markers"))


def markers_count(markers: DataFrame) -> DataFrame:
    return markers.groupBy("contig").agg(F.count("*").alias("n_markers"))


def cluster_markers(bins: DataFrame, markers: DataFrame) -> DataFrame:
    """(cluster, sacc, n) over the contigs of each cluster."""
    own = bins.filter("cluster is not null").select("contig", "cluster")
    return own.join(marker_counts(markers), "contig").groupBy("cluster", "sacc").agg(F.sum("n").alias("n"))


def reference_markers(markers: DataFrame) -> DataFrame:
    """One row: the number of different markers in the whole table, the measure of completeness."""
    return markers.select(F.count_distinct("sacc").alias("expected"))


def bin_metrics(bins: DataFrame, markers: DataFrame, expected: int | None = None) -> DataFrame:
    """(cluster, completeness, purity, coverage_stddev, gc_content_stddev): present markers of all, markers once present of those present, sample deviations.

    A cluster without markers has completeness 0 and no purity; of one contig, no deviations.
    """
    per = cluster_markers(bins, markers).groupBy("cluster").agg(F.count_if(F.col("n") >= 1).alias("present"), F.count_if(F.col("n") == 1).alias("single"))
    ref = bins.sparkSession.range(1).select(F.lit(expected).cast("long").alias("expected")) if expected else reference_markers(markers)
    own = bins.filter("cluster is not null").groupBy("cluster").agg(F.stddev_samp("coverage").alias("coverage_stddev"), F.stddev_samp("gc_content").alias("gc_content_stddev"))
    rows = own.join(per, "cluster", "left").crossJoin(F.broadcast(ref))  # one row
    present = F.coalesce("present", F.lit(0))
    return rows.select("cluster", (present * 100.0 / F.nullif("expected", F.lit(0))).alias("completeness"), (F.coalesce("single", F.lit(0)) * 100.0 / F.nullif(present, F.lit(0))).alias("purity"), "coverage_stddev", "gc_content_stddev")


def add_metrics(bins: DataFrame, markers: DataFrame, expected: int | None = None) -> DataFrame:
    """bins with the metrics of each contig's cluster."""
    return bins.drop(*METRICS).join(bin_metrics(bins, markers, expected), "cluster", "left")


def metric_filter(rows: DataFrame, completeness: float = 20.0, purity: float = 95.0, coverage_stddev: float = 25.0, gc_content_stddev: float = 5.0) -> DataFrame:
    """Rows that meet all four limits; a missing metric fails."""
    if missing := set(METRICS) - set(rows.columns):
        raise KeyError(f"no column {', '.join(sorted(missing))}")
    return rows.filter((F.col("completeness") >= completeness) & (F.col("purity") >= purity) & (F.col("coverage_stddev") <= coverage_stddev) & (F.col("gc_content_stddev") <= gc_content_stddev))
