"""k-mer composition: counts by canonical k-mer, log-ratio normalisation and principal components.

Counts are long rows (contig, kmer, n) with n of 1 or more; a wide table is made only for a sink.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import canonical
from ..session import checkpoint, ship

#: Window starts cut off a sequence at once: substring walks from the start of its string, so long strings would cost their square.
CHUNK = 256


def canonical_kmers(size: int) -> list[str]:
    """All canonical k-mers in the order A, T, C, G; the first seen of two strands."""
    if size < 1:
        raise ValueError("the size must be 1 or more")
    seen, out, pair = set(), [], str.maketrans("ACGT", "TGCA")
    for k in map("".join, product("ATCG", repeat=size)):
        if k not in seen:
            out.append(k)
            seen |= {k, k.translate(pair)[::-1]}
    return out


def count(contigs: DataFrame, size: int = 5, include_last: bool = False) -> DataFrame:
    """(contig, kmer, n) over windows of A, C, G and T; the last window of a contig is left out unless asked for."""
    windows = F.length("sequence") - size + (1 if include_last else 0)
    rows = contigs.select("contig", "sequence", windows.alias("w")).filter("w > 0").repartition("contig")
    pieces = rows.select("contig", "w", F.posexplode(F.transform(F.sequence(F.lit(0), ((F.col("w") - 1) / CHUNK).cast("int")), lambda b: F.substring(F.col("sequence"), b * CHUNK + 1, F.lit(CHUNK + size - 1)))).alias("b", "piece"))
    starts = F.least(F.lit(CHUNK), F.col("w") - F.col("b") * CHUNK)
    kmers = pieces.select("contig", F.explode(F.transform(F.sequence(F.lit(1), starts), lambda i: F.substring(F.col("piece"), i, F.lit(size)))).alias("kmer"))
    raw = kmers.filter(F.col("kmer").rlike("^[ACGT]+$")).groupBy("contig", "kmer").agg(F.count("*").alias("n"))
    return raw.groupBy("contig", canonical(F.col("kmer")).alias("kmer")).agg(F.sum("n").alias("n"))  # strands are folded once counted


def wide(counts: DataFrame, size: int = 5, contigs: DataFrame | None = None) -> DataFrame:
    """A column for each canonical k-mer, null where none; contigs adds those without any."""
    out = counts.groupBy("contig").pivot("kmer", canonical_kmers(size)).agg(F.sum("n"))
    return contigs.select("contig").distinct().join(out, "contig", "left") if contigs is not None else out


def am_clr(counts: DataFrame) -> DataFrame:
    """ln(n + 1) less its mean over the k-mers that occur anywhere; contigs without any are dropped."""
    logs = counts.select("contig", "kmer", F.log1p("n").alias("l"))
    size = counts.select(F.count_distinct("kmer").alias("d"))  # ln 1 = 0: a zero adds to the number of k-mers alone
    means = logs.groupBy("contig").agg(F.sum("l").alias("s")).crossJoin(F.broadcast(size)).select("contig", (F.col("s") / F.col("d")).alias("m"))
    kmers = counts.select("kmer").distinct()
    grid = means.crossJoin(F.broadcast(kmers)).join(logs, ["contig", "kmer"], "left")
    return grid.select("contig", "kmer", (F.coalesce("l", F.lit(0.0)) - F.col("m")).alias("value"))


def clr(counts: DataFrame, size: int = 5) -> DataFrame:
    """Centred log ratios of shares whose zeros are replaced by 1 / D ** 2, D being the number of canonical k-mers; the others give up as much."""
    names = canonical_kmers(size)
    d = len(names)
    delta = 1 / d**2
    kmers = counts.sparkSession.createDataFrame([(k,) for k in names], "kmer string")
    totals = counts.groupBy("contig").agg(F.sum("n").alias("t"), F.count("*").alias("k"))
    grid = totals.crossJoin(F.broadcast(kmers)).join(counts, ["contig", "kmer"], "left")
    share = F.when(F.col("n").isNull(), F.lit(delta)).otherwise(F.col("n") / F.col("t") * (1 - (d - F.col("k")) * delta))
    logs = grid.select("contig", "kmer", F.log(share).alias("l"))
    means = logs.groupBy("contig").agg(F.avg("l").alias("m"))
    return logs.join(means, "contig").select("contig", "kmer", (F.col("l") - F.col("m")).alias("value"))


def ilr(counts: DataFrame, size: int = 5) -> DataFrame:
    """(contig, features): clr in an orthonormal basis of D - 1 axes, the i-th setting the mean of the first i parts against the next."""
    names = canonical_kmers(size)
    ship(counts.sparkSession)

    def turn(batches):
        basis = _ilr_basis(len(names))
        for b in batches:
            x = np.array(b["values"].tolist())
            yield pd.DataFrame({"contig": b["contig"], "features": list(x @ basis.T) if len(b) else []})

    order = F.array(*[F.lit(k) for k in names])
    rows = clr(counts, size).groupBy("contig").agg(F.map_from_entries(F.collect_list(F.struct("kmer", "value"))).alias("m"))
    return rows.select("contig", F.transform(order, lambda k: F.element_at("m", k)).alias("values")).mapInPandas(turn, "contig string, features array<double>")


def _ilr_basis(d: int) -> np.ndarray:
    i = np.arange(1, d)[:, None]
    j = np.arange(d)[None, :]
    return np.where(j < i, np.sqrt(1 / (i * (i + 1))), np.where(j == i, -np.sqrt(i / (i + 1)), 0.0))


def normalize(counts: DataFrame, method: str = "am_clr", size: int = 5) -> DataFrame:
    """By name: am_clr or clr as long rows, ilr as arrays."""
    methods = {"am_clr": lambda: am_clr(counts), "clr": lambda: clr(counts, size), "ilr": lambda: ilr(counts, size)}
    if method not in methods:
        raise ValueError(f"unknown method {method}; there are {', '.join(methods)}")
    return methods[method]()


def features(normalized: DataFrame) -> DataFrame:
    """(contig, features): the values of long rows in k-mer order."""
    rows = normalized.groupBy("contig").agg(F.array_sort(F.collect_list(F.struct("kmer", "value"))).alias("v"))
    return rows.select("contig", F.col("v.value").alias("features"))


def pca(rows: DataFrame, dims: int = 50) -> DataFrame:
    """(contig, features) projected on the first components of the centred features; the sign of each is such that its largest loading is above 0. Untouched if there are no more features than dims."""
    rows = checkpoint(rows.select("contig", "features"))  # read by each of the fits below
    width = rows.select(F.size("features").alias("n")).first()
    if width is None or dims == 0 or width.n <= dims:
        return rows.select("contig", "features")
    vectors = rows.select("contig", array_to_vector(F.col("features")).alias("v"))
    model = PCA(k=dims, inputCol="v", outputCol="p").fit(vectors)
    axes = model.pc.toArray()
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    means = rows.select(F.posexplode("features").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()  # one number for each feature
    shift = np.array([r.m for r in means]) @ axes
    flip, off = F.array(*map(F.lit, signs.tolist())), F.array(*map(F.lit, shift.tolist()))
    out = model.transform(vectors).select("contig", vector_to_array("p").alias("p"))
    return out.select("contig", F.transform(F.arrays_zip(F.col("p").alias("p"), off.alias("o"), flip.alias("f")), lambda z: (z["p"] - z["o"]) * z["f"]).alias("features"))
