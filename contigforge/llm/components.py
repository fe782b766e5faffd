"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, release


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars around their least nodes: a node is the larger end of one edge, or the smaller end of some."""
    end = lambda k, n: F.struct(F.col(k).alias("node"), F.lit(n).alias("up"))
    ends = edges.select(F.inline(F.array(end("u", 1), end("v", 0))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n")).filter("up > 1 or (up = 1 and n > 1)").isEmpty()


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them; in every edge u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every node with an edge; component is the least node reachable. Loops and repeats are allowed.

    The graph is written to the checkpoint folder after each round, until it is a forest of stars; only that comes to the driver.
    """
    a, b = F.col(u), F.col(v)
    now = checkpoint(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    while not _settled(now):
        now = checkpoint(_small(_large(now)))
        release(edges.sparkSession)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def renamed(table: DataFrame, column: str, step: DataFrame) -> DataFrame:
    """table with the component that step = components() gives the node in this column, or the node itself where it has no edge."""
    step = step.withColumnsRenamed({"node": column, "component": "_to"})
    return table.join(step, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")
