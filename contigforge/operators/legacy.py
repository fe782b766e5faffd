"""Computations of older evaluations: per-reference F1, read ranges, accuracy curves, cluster statistics and assembly graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

# The share of G and C in each IUPAC code.
IUPAC_GC = {"G": 1.0, "C": 1.0, "S": 1.0, "R": 0.5, "Y": 0.5, "K": 0.5, "M": 0.5, "N": 0.5, "B": 2 / 3, "V": 2 / 3, "D": 1 / 3, "H": 1 / 3, "A": 0.0, "T": 0.0, "W": 0.0}


def f1_percent(prediction: DataFrame, truth: DataFrame) -> DataFrame:
    """Of each reference genome, by length: the best cluster, or the second best if the best is unclustered; recall, precision (whole percents) and F1 in percent."""
    t = truth.filter("reference_genome <> 'misassembled'").select("contig", "reference_genome", "length")
    cells = prediction.select("contig", F.coalesce("cluster", F.lit("unclustered")).alias("cluster")).join(t, "contig").groupBy("reference_genome", "cluster").agg(F.sum("length").alias("shared"))
    sizes = cells.groupBy("cluster").agg(F.sum("shared").alias("cluster_length"))
    references = t.groupBy("reference_genome").agg(F.sum("length").alias("reference_length"))
    order = F.struct((F.col("cluster") == "unclustered").alias("u"), (-F.col("shared")).alias("s"), "cluster")
    best = cells.groupBy("reference_genome").agg(F.min_by(F.struct("cluster", "shared"), order).alias("b")).select("reference_genome", "b.*")
    x = best.join(references, "reference_genome").join(sizes, "cluster")
    recall, precision = F.col("shared") * 100.0 / F.col("reference_length"), F.round(F.col("shared") * 100.0 / F.col("cluster_length"), 0)
    x = x.select("reference_genome", "cluster", recall.alias("recall"), precision.alias("precision"))
    return x.withColumn("f1", F.coalesce(2 * F.col("recall") * F.col("precision") / F.nullif(F.col("recall") + F.col("precision"), F.lit(0.0)), F.lit(0.0)))


def f1_summary(scores: DataFrame) -> DataFrame:
    """One row: sum and median of F1 to one place, misassembled and missing left out."""
    x = scores.filter("reference_genome <> 'misassembled' and f1 is not null and not isnan(f1)")
    return x.agg(F.round(F.sum("f1"), 1).alias("sum_f1"), F.round(F.median("f1"), 1).alias("median_f1"))


#: Numbers to a cell when ranges are looked up.
CELL = 1 << 12


def in_ranges(reads: DataFrame, ranges: DataFrame) -> DataFrame:
    """reads (number) with the columns of the range (start, end) that holds them, as integers. Ranges are cut into cells of numbers, so the join is on equal cells."""
    cells = ranges.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / CELL), F.floor(F.col("end") / CELL))))
    return reads.withColumn("_cell", F.floor(F.col("number") / CELL)).join(cells, "_cell").filter("number between start and end").drop("_cell", "start", "end")


def read_shares(rows: DataFrame, paired: int = 1) -> DataFrame:
    """(contig, species, reads, percent) of reads by contig and species; paired multiplies the reads."""
    per = rows.groupBy("contig", "species").agg((F.count("*") * paired).alias("reads"))
    return per.withColumn("percent", F.col("reads") * 100.0 / F.sum("reads").over(Window.partitionBy("contig")))


def chimeras(shares: DataFrame, limit: float = 90.0) -> DataFrame:
    """Contigs whose main species has less than limit percent of the reads."""
    best = shares.groupBy("contig").agg(F.min_by(F.struct("species", "percent"), F.struct((-F.col("percent")).alias("p"), "species")).alias("b"))
    return best.select("contig", "b.*").withColumn("chimeric", F.col("percent") < limit)


def claim_bins(cells: DataFrame) -> list[tuple[str, str]]:
    """Greedy pairs (species, bin), the largest overlap first, each used once. cells: species, bin, n, a row for each pair; only these come to the driver."""
    taken_s, taken_b, out = set(), set(), []
    for r in cells.orderBy(F.col("n").desc(), "species", "bin").toLocalIterator():
        if r.species not in taken_s and r.bin not in taken_b:
            taken_s.add(r.species)
            taken_b.add(r.bin)
            out.append((r.species, r.bin))
    return out


def accuracy_by_length(rows: DataFrame, bucket: int = 10_000) -> DataFrame:
    """(length_bucket, n, correct, accuracy): rows (length, predicted, actual) by length rounded up to buckets."""
    ok = F.count_if(F.col("predicted") == F.col("actual"))
    return rows.groupBy((F.ceil(F.col("length") / bucket) * bucket).alias("length_bucket")).agg(F.count("*").alias("n"), ok.alias("correct"), (ok * 100.0 / F.count("*")).alias("accuracy"))


def accuracy_by_confidence(rows: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("predicted") == F.col("actual"))
    return rows.groupBy("confidence").agg(F.count("*").alias("n"), (ok * 100.0 / F.count("*")).alias("accuracy"))


def cluster_summary(bins: DataFrame, markers: DataFrame, expected: int = 139) -> DataFrame:
    """Of each cluster: size, longest, N50 in rising order past the half, unique over all markers, and completeness against a fixed number."""
    sizes = bins.filter("cluster is not null").groupBy("cluster", "length").agg(F.sum("length").alias("bases"))
    w = Window.partitionBy("cluster")
    run = sizes.withColumn("cum", F.sum("bases").over(w.orderBy("length"))).withColumn("total", F.sum("bases").over(w))
    n50 = run.groupBy("cluster").agg(F.min(F.when(F.col("cum") > F.col("total") / 2, F.col("length"))).cast("long").alias("n50"), F.max("total").cast("long").alias("size"), F.max("length").cast("long").alias("longest"))
    from .markers import cluster_markers

    m = cluster_markers(bins, markers).groupBy("cluster").agg(F.sum("n").alias("total_markers"), F.count("*").alias("present"), F.count_if(F.col("n") == 1).alias("unique"))
    return n50.join(m, "cluster", "left").select("cluster", "size", "longest", "n50", (F.coalesce("present", F.lit(0)) * 100.0 / expected).alias("completeness"), (F.col("unique") * 100.0 / F.nullif("total_markers", F.lit(0))).alias("purity"))


def cluster_gc(contigs: DataFrame, bins: DataFrame) -> DataFrame:
    """GC percent of each cluster with the IUPAC codes by their share."""
    upper = F.upper("sequence")
    count = lambda c: F.length("sequence") - F.length(F.replace(upper, F.lit(c)))
    gc = sum((count(c) * F.lit(w) for c, w in IUPAC_GC.items() if w), F.lit(0.0))
    rows = contigs.join(bins.filter("cluster is not null").select("contig", "cluster"), "contig")
    return rows.groupBy("cluster").agg((F.sum(gc) * 100.0 / F.sum(F.length("sequence"))).alias("gc_percent"))


def graph_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached. Labels are lowered and then followed to their own label, so rounds are the logarithm of the longest way."""
    both = edges.select("u", "v").union(edges.select("v", "u")).filter("u <> v").distinct()
    now = checkpoint(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node"))
    while True:
        near = both.join(now.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        lower = now.join(near, now.node == near.u).select("node", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        jump = lower.select(F.col("node").alias("j"), F.col("new").alias("far"))
        new = checkpoint(lower.join(jump, lower.new == jump.j).select("node", F.least("new", "far").alias("label"), "old"))
        if new.filter("label <> old").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        now = new.select("node", "label")


def graph_ends(links: DataFrame) -> DataFrame:
    """Edges between segment ends (segment and strand) that a link joins."""
    return links.select(F.concat("from_segment", F.lit(":"), "from_orient").alias("u"), F.concat("to_segment", F.lit(":"), "to_orient").alias("v"))


def log_rollup(log: DataFrame, by: str = "rank") -> DataFrame:
    """(by, n, seconds, hours, slowest) of log rows (by, what, seconds)."""
    return log.groupBy(by).agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"), (F.sum("seconds") / 3600).alias("hours"), F.min_by("what", F.struct((-F.col("seconds")).alias("s"), "what")).alias("slowest"))


def distinct_per(rows: DataFrame, by: str, *columns: str) -> DataFrame:
    return rows.groupBy(by).agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def training_label(rows: DataFrame) -> DataFrame:
    """reference_genome as a training label: misassembled contigs and those without markers are unclustered."""
    return rows.withColumn("label", F.when((F.col("reference_genome") == "misassembled") | (F.coalesce("n_markers", F.lit(0)) == 0), "unclustered").otherwise(F.col("reference_genome")))


def forward_fill(rows: DataFrame, by: str, order: str, column: str) -> DataFrame:
    return rows.withColumn(column, F.last(column, ignorenulls=True).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
