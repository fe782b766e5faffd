"""Benchmarks of bins and taxa against a truth: clustering indices, multilabel lineage scores and dominant-cluster scores.

All indices come from the contingency table, whose cells, not contigs, are summed; adjusted mutual information alone works on its margins on the driver.
"""

from __future__ import annotations

from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ROOT
from .taxonomy import paths

NOISE = -1


def labels(prediction: DataFrame, truth: DataFrame, predicted: str = "cluster", reference: str = "reference_genome") -> DataFrame:
    """(contig, p, t) of the predicted contigs: labels as text; null and, in the prediction, unclustered are one class, as is an absent or misassembled truth."""
    p = prediction.select("contig", F.when(F.col(predicted) == "unclustered", None).otherwise(F.col(predicted)).cast("string").alias("p"))
    t = truth.filter(F.col(reference) != "misassembled").select("contig", F.col(reference).cast("string").alias("t"))
    return p.join(t, "contig", "left").select("contig", F.coalesce("p", F.lit("-1")).alias("p"), F.coalesce("t", F.lit("-1")).alias("t"))


def codes(pairs: DataFrame, column: str) -> DataFrame:
    """The number of each label in the order of labels, from 0; -1 for none."""
    from pyspark.sql import Window

    names = pairs.filter(F.col(column) != "-1").select(column).distinct()
    numbered = names.withColumn("code", F.row_number().over(Window.orderBy(column)) - 1)  # a row for each label
    return pairs.join(numbered, column, "left").withColumn("code", F.coalesce("code", F.lit(NOISE)))


def contingency(pairs: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return pairs.groupBy(*by, "p", "t").agg(F.count("*").alias("n"))


def _entropy(n: Column, total: Column) -> Column:
    return F.sum(-n / total * F.log(n / total))


def clustering_scores(pairs: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """ARI, NMI by four averages, homogeneity, completeness, V-measure and Fowlkes-Mallows, for each group."""
    cells = contingency(pairs, by)
    keys = by or ["_all"]
    if not by:
        cells = cells.withColumn("_all", F.lit(0))
    two = lambda n: n * (n - 1) / 2
    total = cells.groupBy(*keys).agg(F.sum("n").cast("double").alias("total"), F.sum(two(F.col("n"))).alias("s_pt"))

    def margin(side: str) -> DataFrame:
        m = cells.groupBy(*keys, side).agg(F.sum("n").alias("m")).join(total.select(*keys, "total"), keys)
        return m.groupBy(*keys).agg(F.sum(two(F.col("m"))).alias(f"s_{side}"), _entropy(F.col("m"), F.col("total")).alias(f"h_{side}"))

    joint = cells.join(total.select(*keys, "total"), keys).groupBy(*keys).agg(_entropy(F.col("n"), F.col("total")).alias("h_pt"))
    x = total.join(margin("p"), keys).join(margin("t"), keys).join(joint, keys)
    mi = F.greatest(F.lit(0.0), F.col("h_p") + F.col("h_t") - F.col("h_pt"))
    all_pairs = two(F.col("total"))
    expected = F.col("s_p") * F.col("s_t") / F.nullif(all_pairs, F.lit(0.0))
    most = (F.col("s_p") + F.col("s_t")) / 2
    ari = F.when(F.coalesce(most - expected, F.lit(0.0)) == 0, 1.0).otherwise((F.col("s_pt") - expected) / F.nullif(most - expected, F.lit(0.0)))

    def share(of: Column) -> Column:
        return F.when((F.col("h_p") <= 0) & (F.col("h_t") <= 0), 1.0).when(of <= 0, 0.0).otherwise(mi / of)

    part = lambda h: F.when(F.col(h) <= 0, 1.0).otherwise(mi / F.col(h))
    out = x.select(*by, ari.alias("ari"), share(F.least("h_p", "h_t")).alias("nmi_min"), share(F.sqrt(F.col("h_p") * F.col("h_t"))).alias("nmi_geometric"), share((F.col("h_p") + F.col("h_t")) / 2).alias("nmi_arithmetic"), share(F.greatest("h_p", "h_t")).alias("nmi_max"), part("h_t").alias("homogeneity"), part("h_p").alias("completeness"), F.coalesce(F.col("s_pt") / F.sqrt(F.nullif(F.col("s_p") * F.col("s_t"), F.lit(0.0))), F.lit(0.0)).alias("fowlkes_mallows"))
    return out.withColumn("v_measure", F.when(F.col("homogeneity") + F.col("completeness") == 0, 0.0).otherwise(2 * F.col("homogeneity") * F.col("completeness") / F.nullif(F.col("homogeneity") + F.col("completeness"), F.lit(0.0))))


def adjusted_mutual_information(pairs: DataFrame) -> float:
    """AMI with the arithmetic average: its expectation under fixed margins is a sum over pairs of different margin sizes, worked out on the driver."""
    cells = contingency(pairs)
    side = lambda s: cells.groupBy(s).agg(F.sum("n").alias("m")).groupBy("m").count().collect()
    a, b = [(r.m, r["count"]) for r in side("p")], [(r.m, r["count"]) for r in side("t")]
    n = sum(m * k for m, k in a)
    if n == 0 or sum(k for _, k in a) == 1 == sum(k for _, k in b):
        return 1.0
    h = lambda x: -sum(k * m / n * log(m / n) for m, k in x)
    hp, ht = h(a), h(b)
    joint = cells.agg(F.sum(-F.col("n") / n * F.log(F.col("n") / n)).alias("h")).first().h
    mi = hp + ht - joint
    expected = 0.0
    for x, kx in a:
        for y, ky in b:
            fixed = lgamma(x + 1) + lgamma(y + 1) + lgamma(n - x + 1) + lgamma(n - y + 1) - lgamma(n + 1)
            for c in range(max(1, x + y - n), min(x, y) + 1):
                expected += kx * ky * c / n * log(n * c / (x * y)) * exp(fixed - lgamma(c + 1) - lgamma(x - c + 1) - lgamma(y - c + 1) - lgamma(n - x - y + c + 1))
    span = (hp + ht) / 2 - expected
    return (mi - expected) / span if abs(span) > 1e-15 else (mi - expected) / (1e-15 if span >= 0 else -1e-15)


def lineage_scores(prediction: DataFrame, truth: DataFrame, tree: DataFrame) -> DataFrame:
    """(taxid, precision, recall, f1, support) of every taxon in the lineages of predicted or true taxids, 0 where undefined; a taxid of 0 or null is the root."""
    path = paths(tree)
    fix = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) == 0, F.lit(ROOT)).otherwise(F.col(c)).cast("int")
    rows = prediction.select("contig", fix("taxid").alias("p")).join(truth.select("contig", fix("taxid").alias("t")), "contig")
    up = lambda side: rows.select("contig", F.col(side).alias("taxid")).join(path, "taxid").select("contig", F.explode("path").alias("taxid"))
    both = up("p").withColumn("p", F.lit(1)).join(up("t").withColumn("t", F.lit(1)), ["contig", "taxid"], "full")
    per = both.groupBy("taxid").agg(F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("tp"), F.count("p").alias("pp"), F.count("t").alias("support"))
    precision, recall = F.coalesce(F.col("tp") / F.nullif("pp", F.lit(0)), F.lit(0.0)), F.coalesce(F.col("tp") / F.nullif("support", F.lit(0)), F.lit(0.0))
    out = per.select("taxid", precision.alias("precision"), recall.alias("recall"), "support")
    return out.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))


def weighted_scores(per_taxon: DataFrame) -> DataFrame:
    """One row: averages weighted by support."""
    w = F.nullif(F.sum("support"), F.lit(0))
    return per_taxon.agg(*[(F.sum(F.col(c) * F.col("support")) / w).alias(c) for c in ("precision", "recall", "f1")])


def sample_scores(prediction: DataFrame, truth: DataFrame, tree: DataFrame) -> DataFrame:
    """One row: precision, recall and F1 of each contig's lineage, averaged over contigs."""
    path = paths(tree)
    fix = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) == 0, F.lit(ROOT)).otherwise(F.col(c)).cast("int")
    rows = prediction.select("contig", fix("taxid").alias("p")).join(truth.select("contig", fix("taxid").alias("t")), "contig")
    rows = rows.join(path.select(F.col("taxid").alias("p"), F.col("path").alias("pp")), "p").join(path.select(F.col("taxid").alias("t"), F.col("path").alias("tt")), "t")
    tp = F.size(F.array_intersect("pp", "tt"))
    return rows.select((tp / F.size("pp")).alias("p"), (tp / F.size("tt")).alias("r")).agg(F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg(F.coalesce(2 * F.col("p") * F.col("r") / F.nullif(F.col("p") + F.col("r"), F.lit(0.0)), F.lit(0.0))).alias("f1"))


def binning_classification(prediction: DataFrame, truth: DataFrame) -> DataFrame:
    """Of each reference genome its dominant cluster by shared length, of equals the first by name: precision is the shared length over the reference's, recall over the cluster's, as they are commonly swapped here; and F1.

    truth: contig, reference_genome, length; misassembled ones and unclustered contigs are left out.
    """
    t = truth.filter("reference_genome is not null and reference_genome <> 'misassembled'").select("contig", "reference_genome", "length")
    p = prediction.filter("cluster is not null and cluster <> 'unclustered'").select("contig", "cluster")
    cells = p.join(t, "contig").groupBy("reference_genome", "cluster").agg(F.sum("length").alias("shared"), F.count("*").alias("contigs"))
    references = t.groupBy("reference_genome").agg(F.sum("length").alias("reference_length"))
    clusters = cells.groupBy("cluster").agg(F.sum("shared").alias("cluster_length"))
    best = cells.groupBy("reference_genome").agg(F.min_by(F.struct("cluster", "shared", "contigs"), F.struct((-F.col("shared")).alias("s"), "cluster")).alias("b"))
    x = best.select("reference_genome", "b.*").join(references, "reference_genome").join(clusters, "cluster")
    x = x.select("reference_genome", "cluster", "shared", "contigs", (F.col("shared") / F.nullif("reference_length", F.lit(0))).alias("precision"), (F.col("shared") / F.nullif("cluster_length", F.lit(0))).alias("recall"))
    return x.withColumn("f1", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0)))


def long_scores(wide: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, metric, score): a row for each metric."""
    return wide.unpivot(keys, metrics, "metric", "score")


def report(per_taxon: DataFrame, tree: DataFrame) -> DataFrame:
    """Scores with each taxon's name and rank."""
    return per_taxon.join(tree.select("taxid", "name", "rank"), "taxid", "left")
