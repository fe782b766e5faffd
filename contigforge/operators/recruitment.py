"""Recruitment of unclustered contigs into bins by classifiers over composition, coverage and taxonomy."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RANKS
from ..session import checkpoint
from .markers import cluster_markers


#: The greatest depth of a tree that the library allows.
DEPTH = 30


def one_hot_ranks(rows: DataFrame, ranks: tuple[str, ...] = tuple(reversed(RANKS[1:]))) -> DataFrame:
    """(contig, taxa): an indicator for each name at each rank; of the names, which the driver lists, there must be few enough for a feature vector."""
    out = []
    for r in [r for r in ranks if r in rows.columns]:
        names = [x[0] for x in rows.select(r).distinct().orderBy(r).collect()]
        out += [F.when(F.col(r).eqNullSafe(F.lit(n)), 1.0).otherwise(0.0) for n in names]
    return rows.select("contig", (F.array(*out) if out else F.array().cast("array<double>")).alias("taxa"))


def features(composition: DataFrame, coverage: DataFrame, taxonomy: DataFrame | None = None, *extra: DataFrame) -> DataFrame:
    """(contig, features): composition's features, coverage, indicators of taxa and the numbers of further tables, joined by contig."""
    rows = composition.select("contig", "features").join(coverage.select("contig", "coverage"), "contig").select("contig", F.concat("features", F.array(F.col("coverage").cast("double"))).alias("features"))
    if taxonomy is not None:
        rows = rows.join(one_hot_ranks(taxonomy), "contig").select("contig", F.concat("features", "taxa").alias("features"))
    for table in extra:
        numbers = [f"`{c}`" for c in table.columns if c != "contig"]
        rows = rows.join(table.select("contig", F.array(*[F.expr(c).cast("double") for c in numbers]).alias("_x")), "contig").select("contig", F.concat("features", "_x").alias("features"))
    return rows


def split(rows: DataFrame, bins: DataFrame, markers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test): clustered contigs that have a marker, with their cluster; unclustered contigs. Joined by contig."""
    marked = markers.select("contig").distinct()
    train = rows.join(bins.filter("cluster is not null").select("contig", "cluster"), "contig").join(marked, "contig", "left_semi")
    return train, rows.join(bins.filter("cluster is null").select("contig"), "contig", "left_semi")


def _fit(train: DataFrame, tree) -> Pipeline:
    labelled = train.withColumn("v", array_to_vector("features"))
    names = StringIndexer(inputCol="cluster", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip").fit(train)
    return names, tree.fit(names.transform(labelled))


def _votes(model, names, test: DataFrame) -> DataFrame:
    labels = F.array(*map(F.lit, names.labels))
    return model.transform(test.withColumn("v", array_to_vector("features"))).select("contig", F.element_at(labels, F.col("prediction").cast("int") + 1).alias("cluster"))


def tree_votes(train: DataFrame, test: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """(contig, cluster, votes): a decision tree on each of n halves of the training rows, dealt by a hash of the contig and the seed. One tree chooses one cluster for a contig."""
    out = None
    for i in range(n):
        half = train.filter(F.pmod(F.xxhash64("contig", F.lit(seed + i)), F.lit(2)) == 0)
        if half.isEmpty():
            continue
        names, model = _fit(half, DecisionTreeClassifier(featuresCol="v", labelCol="label", seed=seed + i, maxDepth=DEPTH))
        one = _votes(model, names, test)
        out = one if out is None else out.unionByName(one)
    if out is None:
        return test.select("contig", F.lit(None).cast("string").alias("cluster"), F.lit(0).cast("long").alias("votes")).limit(0)
    return out.groupBy("contig", "cluster").agg(F.count("*").alias("votes"))


def forest_votes(train: DataFrame, test: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """(contig, cluster, votes): one forest of n trees, each on half of the rows; votes is the class share times n, rounded."""
    names, model = _fit(train, RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=n, subsamplingRate=0.5, seed=seed, maxDepth=DEPTH))
    labels = F.array(*map(F.lit, names.labels))
    p = model.transform(test.withColumn("v", array_to_vector("features"))).select("contig", F.posexplode(vector_to_array("probability")).alias("i", "p"))
    return p.select("contig", F.element_at(labels, F.col("i") + 1).alias("cluster"), F.round(F.col("p") * n).cast("long").alias("votes")).filter("votes > 0")


CLASSIFIERS = {"decision_tree": tree_votes, "random_forest": forest_votes}


def confident(votes: DataFrame, n: int = 10, confidence: float = 1.0) -> DataFrame:
    """(contig, cluster): each contig's cluster of most votes, of equals the first by name, if it has confidence * n votes."""
    best = votes.groupBy("contig").agg(F.min_by(F.struct("cluster", "votes"), F.struct((-F.col("votes")).alias("v"), "cluster")).alias("_b"))
    return best.filter(F.col("_b.votes") >= n * confidence).select("contig", F.col("_b.cluster").alias("cluster"))


def uncontaminated(predictions: DataFrame, bins: DataFrame, markers: DataFrame) -> DataFrame:
    """Predictions without those of clusters whose number of single-copy markers would fall: all of a cluster's, or none."""
    known = bins.filter("cluster is not null").select("contig", "cluster")
    single = lambda rows: cluster_markers(rows, markers).groupBy("cluster").agg(F.count_if(F.col("n") == 1).alias("single"))
    before = single(known).withColumnRenamed("single", "was")
    after = single(known.unionByName(predictions.select("contig", "cluster")))
    worse = predictions.select("cluster").distinct().join(before, "cluster", "left").join(after, "cluster", "left").filter(F.coalesce("single", F.lit(0)) < F.coalesce("was", F.lit(0)))
    return predictions.join(worse.select("cluster"), "cluster", "left_anti").select("contig", "cluster")


def add_predictions(bins: DataFrame, predictions: DataFrame) -> DataFrame:
    new = predictions.select("contig", F.col("cluster").alias("_new"))
    return bins.join(new, "contig", "left").withColumn("cluster", F.coalesce("cluster", "_new")).drop("_new")


def recruit(rows: DataFrame, bins: DataFrame, markers: DataFrame, classifier: str = "decision_tree", n: int = 10, confidence: float = 1.0, seed: int = 42) -> DataFrame:
    """bins with recruited_cluster: rounds of train, predict, filter and veto until nothing more is recruited; cluster stays as it was."""
    if classifier not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {classifier}; there are {', '.join(CLASSIFIERS)}")
    now = checkpoint(bins.select("contig", "cluster"))
    while True:
        train, test = split(rows, now, markers)
        if test.isEmpty() or train.isEmpty():
            break
        new = checkpoint(uncontaminated(confident(CLASSIFIERS[classifier](train, test, n, seed), n, confidence), now, markers))
        if new.isEmpty():
            break
        now = checkpoint(add_predictions(now, new))
    return bins.join(now.select("contig", F.col("cluster").alias("recruited_cluster")), "contig", "left")
