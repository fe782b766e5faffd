"""Clustering of contigs into bins: density kernels, their parameter sweeps, and the rounds guided by taxonomy.

A kernel sees the contigs of one taxon; taxa of a rank run side by side. min_samples = 1 makes DBSCAN the components of the graph of
distances up to eps, so one minimum spanning tree is cut at every eps of the sweep. Trees are grown with one row of distances at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import zero_padded
from ..schemas import RANKS, UNCLASSIFIED
from ..session import batches_of, checkpoint, scratch, ship, spread
from .markers import METRICS


#: Of the HDBSCAN sweep: cluster size at which it begins again, and samples from which that size doubles.
MOST_SIZE, MOST_SAMPLES = 10_000, 10
#: Markers that are looked at together.
BLOCK = 1_000_000


class BinningError(RuntimeError):
    """No cluster could be recovered."""


class NoMarkersError(ValueError):
    """No contig has a marker, so clusters cannot be judged."""


@dataclass(frozen=True)
class Limits:
    completeness: float = 20.0
    purity: float = 95.0
    coverage_stddev: float = 25.0
    gc_content_stddev: float = 5.0


def _distances(columns: np.ndarray, point: np.ndarray) -> np.ndarray:
    """From a point to all others; columns: a row for each dimension."""
    out = np.zeros(columns.shape[1])
    for column, at in zip(columns, point, strict=True):
        apart = column - at
        apart *= apart
        out += apart
    return np.sqrt(out, out=out)


def spanning_tree(x: np.ndarray, core: np.ndarray | None = None) -> np.ndarray:
    """Rows (a, b, weight) of a minimum spanning tree by distance, or by mutual reachability if core distances are given.

    One product tells which rows can come closer by a new point, with room for rounding; only theirs are worked out as distances.
    """
    n = len(x)
    out, x = np.empty((max(n - 1, 0), 3)), np.ascontiguousarray(x, float)
    middle = x - (x.mean(0) if n else 0)
    square = (middle**2).sum(1)
    room = 1e-12 * square.max(initial=0)
    left, best, source, done = np.arange(n), np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, bool)
    near = np.column_stack([2 * middle, np.full(n, np.inf)])  # the last: square of the best distance less that of the row
    at = 0
    for k in range(n - 1):
        name, done[at], best[at], near[at, -1] = left[at], True, np.inf, -np.inf
        if k % 512 == 511 and 8 * done.sum() > len(done):  # what is in the tree is no longer looked at
            keep = ~done
            left, best, source, done, near = left[keep], best[keep], source[keep], done[keep], near[keep]
        some = np.flatnonzero(near @ np.append(middle[name], 1.0) >= square[name] - room) if np.isfinite(room) else np.flatnonzero(~done)
        rows = left[some]
        d = _distances(x[rows].T, x[name])
        if core is not None:
            d = np.maximum(np.maximum(d, core[rows]), core[name])
        closer = d < best[some]
        some, d = some[closer], d[closer]
        source[some], best[some], near[some, -1] = name, d, d * d - square[left[some]]
        at = int(best.argmin())
        if done[at]:  # distances that are no numbers below infinity
            at = int((~done).argmax())
        out[k] = source[at], left[at], best[at]
    return out


class Components:
    """Components of a tree's edges up to a weight that only grows."""

    def __init__(self, tree: np.ndarray, n: int):
        tree = tree[np.argsort(tree[:, 2], kind="stable")]
        self.a, self.b, self.weight = tree[:, 0].astype(int).tolist(), tree[:, 1].astype(int).tolist(), tree[:, 2]
        self.root, self.at = list(range(n)), 0

    def first(self, eps: float) -> np.ndarray:
        """For each row the first row of its component."""
        root, to = self.root, int(np.searchsorted(self.weight, eps, "right"))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for k in range(self.at, to):
            p, q = top(self.a[k]), top(self.b[k])
            root[max(p, q)] = min(p, q)
        self.at = max(self.at, to)
        out = np.array(root, np.int64)
        while (up := out[out]).tobytes() != out.tobytes():
            out = up
        return out


def cut(tree: np.ndarray, n: int, eps: float) -> np.ndarray:
    """Components joined by edges up to eps, numbered by their first row."""
    return pd.factorize(Components(tree, n).first(eps))[0]


def dbscan(x: np.ndarray, eps: float) -> np.ndarray:
    """Labels from 0; every point is a core point."""
    if len(x) == 0:
        return np.zeros(0, np.int64)
    return cut(spanning_tree(x), len(x), eps)


def core_distances(x: np.ndarray, min_samples: int) -> np.ndarray:
    """The distance to the min_samples-th point, itself the first."""
    k = min(min_samples, len(x)) - 1
    return near_distances(x, k + 1)[:, k] if k > 0 else np.zeros(len(x))


def near_distances(x: np.ndarray, k: int) -> np.ndarray:
    """Of each row the k least distances in order, itself the first."""
    columns = np.ascontiguousarray(x.T, float)
    return np.array([np.sort(np.partition(_distances(columns, p), k - 1)[:k]) for p in x]).reshape(len(x), k)


class Linkage:
    """The merges of a tree by weight; rows below a node lie side by side in order."""

    def __init__(self, x: np.ndarray, core: np.ndarray | None = None):
        n = self.n = len(x)
        tree = spanning_tree(x, core)
        tree = tree[np.argsort(tree[:, 2], kind="stable"), :2].astype(int).tolist()
        parent, size, kids = list(range(2 * n - 1)), [1] * n, [(0, 0)] * n
        for new, (a, b) in enumerate(tree, n):
            pair = []
            for i in (a, b):
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                pair.append(i)
                parent[i] = new
            kids.append((pair[0], pair[1]))
            size.append(size[pair[0]] + size[pair[1]])
        start, self.order = [0] * len(kids), np.empty(n, np.int64)
        for node in range(len(kids) - 1, n - 1, -1):
            p, q = kids[node]
            start[p], start[q] = start[node], start[node] + size[p]
        self.order[start[:n]] = np.arange(n)
        self.kids, self.size, self.start = kids, size, start

    def leaves(self, min_cluster_size: int) -> np.ndarray:
        """Leaf clusters of the condensed tree, the whole if it never splits; -1 for points that fall out of a cluster before it ends."""
        n, kids, size = self.n, self.kids, self.size
        labels, leaves = np.full(n, -1), 0
        stack = [len(kids) - 1]
        while stack:
            node = at = stack.pop()
            while at >= n:  # points that fall off leave the cluster, two large children end it
                p, q = kids[at]
                if size[p] >= min_cluster_size and size[q] >= min_cluster_size:
                    stack += [q, p]
                    break
                big = p if size[p] >= size[q] else q
                if size[big] < min_cluster_size:
                    at = -1
                    break
                at = big
            if at < n:
                labels[self.order[self.start[node] : self.start[node] + size[node]]] = leaves
                leaves += 1
        labels[labels >= 0] = pd.factorize(labels[labels >= 0])[0]
        return labels


def hdbscan(x: np.ndarray, min_cluster_size: int = 2, min_samples: int = 1, linkage: Linkage | None = None) -> np.ndarray:
    """Linkage.leaves of the points; none where there are fewer points than a cluster has. linkage: that of x and its core distances, if it is there."""
    if len(x) < max(min_cluster_size, 2):
        return np.full(len(x), -1)
    return (linkage or Linkage(x, core_distances(x, min_samples))).leaves(min_cluster_size)


class Group:
    """Contigs of one taxon for the kernels: their features, coverage, GC and marker counts."""

    def __init__(self, frame: pd.DataFrame, expected: int, marks: tuple[np.ndarray, np.ndarray] | None = None):
        """marks, in place of the column markers: how many each row has, all their codes, and where a row's codes begin."""
        self.frame, self.expected = frame.reset_index(drop=True), max(expected, 1)
        self.x = np.column_stack([np.array(frame["features"].tolist(), float).reshape(len(frame), -1), frame["coverage"].to_numpy(float)])
        if np.isnan(self.x).any():
            raise ValueError("features must not be null")
        if marks is None:
            each = [list(m) if m is not None else [] for m in frame["markers"]]
            marks = np.array([len(m) for m in each], np.int64), pd.factorize(np.array([m for ms in each for m in ms], object))[0] if any(each) else np.zeros(0, np.int64)
            self.start = np.cumsum(marks[0]) - marks[0]
        else:
            self.start = marks[2]
        self.many, self.mark = marks[0], marks[1].astype(np.int32, copy=False)
        self.marks = int(self.mark.max(initial=-1)) + 2

    def _marks(self, rows: np.ndarray) -> np.ndarray:
        """Codes of the markers of rows, one after another; null is 0."""
        many = self.many[rows]
        return self.mark[np.repeat(self.start[rows] - (np.cumsum(many) - many), many) + np.arange(many.sum())] + 1

    def _marker_counts(self, rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each label from 0 the number of its different markers, and of those that it has once; BLOCK markers at a time."""
        many = self.many[rows]
        keep = (labels >= 0) & (many > 0)
        rows, labels, many = rows[keep], labels[keep], many[keep]
        order = np.argsort(labels, kind="stable")
        rows, labels, many = rows[order], labels[order], many[order]
        present, single = (np.zeros(int(labels.max(initial=-1)) + 1, np.int64) for _ in range(2))
        ends, sums = np.flatnonzero(np.diff(labels, append=-1)) + 1, np.concatenate([[0], np.cumsum(many)])
        at = 0
        while at < len(rows):
            to = int(ends[max(np.searchsorted(sums[ends], sums[at] + BLOCK, "right") - 1, np.searchsorted(ends, at, "right"))])  # whole labels, one at least
            if sums[to] - sums[at] > BLOCK:
                times = np.zeros(self.marks, np.int64)
                while at < to:
                    part = max(at + 1, min(to, int(np.searchsorted(sums, sums[at] + BLOCK, "right")) - 1))
                    times += np.bincount(self._marks(rows[at:part]), minlength=self.marks)
                    at = part
                present[labels[to - 1]], single[labels[to - 1]] = (times > 0).sum(), (times == 1).sum()
                continue
            pairs = np.repeat(labels[at:to].astype(np.int64) * self.marks, many[at:to]) + self._marks(rows[at:to])
            pairs.sort()
            new = np.flatnonzero(np.diff(pairs, prepend=-1))
            label, times = pairs[new] // self.marks, np.diff(new, append=len(pairs))
            present += np.bincount(label, minlength=len(present))
            single += np.bincount(label[times == 1], minlength=len(present))
            at = to
        return present, single

    def metrics(self, rows: np.ndarray, labels: np.ndarray) -> pd.DataFrame:
        """Completeness, purity and deviations of each label among these rows; -1 is no label."""
        coverage, gc = self.frame["coverage"].to_numpy(float)[rows], self.frame["gc_content"].to_numpy(float)[rows]
        out = pd.DataFrame({"c": labels, "coverage": coverage, "gc": gc})[labels >= 0].groupby("c").agg(coverage_stddev=("coverage", "std"), gc_content_stddev=("gc", "std"))
        present, single = (np.pad(x, (0, labels.max(initial=-1) + 1 - len(x)))[out.index.to_numpy()] for x in self._marker_counts(rows, labels))
        out["completeness"] = present * 100.0 / self.expected
        with np.errstate(invalid="ignore"):
            out["purity"] = single * 100.0 / present
        return out[list(METRICS)]

    @staticmethod
    def passing(metrics: pd.DataFrame, limits: Limits) -> pd.DataFrame:
        return metrics[(metrics["completeness"] >= limits.completeness) & (metrics["purity"] >= limits.purity) & (metrics["coverage_stddev"] <= limits.coverage_stddev) & (metrics["gc_content_stddev"] <= limits.gc_content_stddev)]

    def _median(self, metrics: pd.DataFrame, limits: Limits) -> float:
        """Median completeness of the passing clusters, each counted once, however many contigs it has."""
        good = self.passing(metrics, limits)["completeness"]
        return float(good.median()) if len(good) else -np.inf

    def sweep_dbscan(self, rows: np.ndarray, limits: Limits) -> np.ndarray:
        """Labels at the eps of the best median completeness; of equals the last. The step grows tenfold once a number of clusters has come over ten times.

        A cluster is judged once, not at each eps at which it is there; one contig has no deviation, so it never passes.
        """
        if len(rows) < 2:
            return np.full(len(rows), -1)
        parts = Components(spanning_tree(self.x[rows]), len(rows))
        eps, step, best, out, rounds, n = 0.3, 0.1, -np.inf, np.full(len(rows), -1), Counter(), np.inf
        judged, passed = np.ones(len(rows), np.int64), np.full(len(rows), np.nan)  # of the component that begins at a row: its size, its completeness if it passes
        while n > 1 and rounds["none"] < 10:
            first = parts.first(eps)
            size = np.bincount(first, minlength=len(rows))
            if (changed := (size != judged) & (size > 0)).any():
                good = self.passing(self.metrics(rows, np.where(changed[first], first, -1)), limits)["completeness"]
                passed[changed], judged[changed] = np.nan, size[changed]
                passed[good.index.to_numpy()] = good.to_numpy(float)
            now = passed[np.flatnonzero(size)]
            now = now[~np.isnan(now)]
            median = float(np.median(now)) if len(now) else -np.inf
            if median >= best:
                best, out = median, first
            n = int((size > 0).sum())
            rounds[n] += 1
            if rounds[n] > 10:
                step *= 10
            rounds["none"] += median == 0
            eps += step
        return pd.factorize(out)[0]

    def sweep_hdbscan(self, rows: np.ndarray, limits: Limits) -> np.ndarray:
        """Labels at the best median completeness, of equals the last; the sweep ends with the first round that has at most one cluster.

        Cluster sizes go from 2 in tens, and by a hundred more after a round in which nothing passes. At MOST_SIZE they begin again with one sample
        more; from MOST_SAMPLES on, each round doubles that size.
        """
        most, size, samples, best, out, n = MOST_SIZE, 2, 1, -np.inf, np.full(len(rows), -1), np.inf
        x, linkage, of, near, before = self.x[rows], None, 0, None, None
        while n > 1:
            if of != samples and len(rows) >= max(size, 2):  # the tree is the same for all cluster sizes
                if samples > 1 and (near is None or near.shape[1] < min(samples, len(x))):
                    near = near_distances(x, min(max(samples, MOST_SAMPLES), len(x)))
                linkage, of = Linkage(x, near[:, min(samples, len(x)) - 1] if samples > 1 else None), samples
            labels = hdbscan(x, size, samples, linkage) if len(rows) > 1 else np.full(len(rows), -1)
            if before is None or (labels != before).any():
                median, before = self._median(self.metrics(rows, labels), limits), labels
            if median >= best:
                best, out = median, labels
            n = len(set(labels[labels >= 0].tolist()))
            size, samples = (2, samples + 1) if size >= most else (size + 10, samples)
            size += 100 if median == -np.inf else 0
            most *= 2 if samples >= MOST_SAMPLES else 1
        return out

    def clusters(self, limits: Limits, method: str = "dbscan") -> pd.DataFrame:
        """(contig, cluster, metrics): rounds of the sweep over what is left, until nothing passes; clusters are numbered from 1 over all rounds."""
        sweeps = {"dbscan": self.sweep_dbscan, "hdbscan": self.sweep_hdbscan}
        if method not in sweeps:
            raise ValueError(f"unknown method {method}; there are {', '.join(sweeps)}")
        rows, number = np.arange(len(self.frame)), np.zeros(len(self.frame), np.int64)
        values = {m: np.full(len(self.frame), np.nan) for m in METRICS}
        done = 0
        while len(rows):
            labels = sweeps[method](rows, limits)
            metrics = self.passing(self.metrics(rows, labels), limits)
            good = np.isin(labels, metrics.index.to_numpy()) & (labels >= 0)
            if not good.any():
                break
            new, names = pd.factorize(labels[good])
            number[rows[good]] = new + 1 + done
            for m in METRICS:
                values[m][rows[good]] = metrics[m].reindex(labels[good]).to_numpy(float)
            done += len(names)
            rows = rows[~good]
        return pd.DataFrame({"contig": self.frame["contig"], "cluster": number, **values})


CLUSTERED_ARROW = pa.schema([("taxon", pa.string()), ("contig", pa.string()), ("cluster", pa.int64()), *((m, pa.float64()) for m in METRICS)])
CLUSTERED = "taxon string, contig string, cluster long, completeness double, purity double, coverage_stddev double, gc_content_stddev double"


def cluster_groups(contigs: DataFrame, expected: int, limits: Limits = Limits(), method: str = "dbscan", by: str = "taxon") -> DataFrame:  # noqa: B008
    """CLUSTERED of each group; cluster 0 is none. contigs: by, contig, features, coverage, gc_content, markers, row_pos."""
    ship(contigs.sparkSession)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markers, rows = Codes(), []
        for batch in batches:
            markers.add(batch.column("markers"))
            rows.append(batch.drop_columns(["markers", "taxon"]).to_pandas())
            del batch
            pa.default_memory_pool().release_unused()
        frame = pd.concat(rows, ignore_index=True)
        order = frame.sort_values(["row_pos", "contig"]).index.to_numpy()
        many, codes = markers.result()
        marks = many[order], codes, (np.cumsum(many) - many)[order]
        out = Group(frame.loc[order], expected, marks).clusters(limits, method)
        out.insert(0, "taxon", str(key[0].as_py()))
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name].to_numpy(), f.type, from_pandas=f.type == pa.string()) for f in CLUSTERED_ARROW], schema=CLUSTERED_ARROW)

    rows = contigs.withColumnRenamed(by, "taxon").select("taxon", "contig", "features", "coverage", "gc_content", "markers", "row_pos")
    return spread(rows, "taxon").groupBy("taxon").applyInArrow(run, CLUSTERED)


class Codes:
    """Texts of lists, batch by batch, as numbers that hold for all batches; -1 for null."""

    def __init__(self):
        self.known, self.codes, self.many = pa.array([], pa.string()), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

    def add(self, lists: pa.ListArray) -> None:
        self.many.append(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        flat = lists.flatten()
        for s in range(0, len(flat), BLOCK):
            texts = flat.slice(s, BLOCK).dictionary_encode()
            at = pc.index_in(texts.dictionary, value_set=self.known)
            new = texts.dictionary.filter(pc.is_null(at))
            self.known = pa.concat_arrays([self.known, new])
            to = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int32)
            to[to < 0] = np.arange(len(self.known) - len(new), len(self.known), dtype=np.int32)
            self.codes.append(np.append(to, np.int32(-1))[pc.fill_null(texts.indices, -1).to_numpy(zero_copy_only=False)])

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """How many texts each list has, and their numbers."""
        out = np.concatenate(self.many), np.concatenate(self.codes)
        self.known, self.codes = None, None
        return out


def dbscan_groups(contigs: DataFrame, eps: float) -> DataFrame:
    """(taxon, contig, first): of each group of contigs (taxon, contig, features, coverage, row_pos), the component of distances up to eps, named by its first contig."""
    ship(contigs.sparkSession)

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["row_pos", "contig"]).reset_index(drop=True)
        x = np.column_stack([np.array(frame["features"].tolist(), float).reshape(len(frame), -1), frame["coverage"].to_numpy(float)])
        labels = dbscan(x, eps)
        first = frame["contig"].groupby(labels).transform("first")
        return pd.DataFrame({"taxon": str(key[0]), "contig": frame["contig"], "first": first})

    return contigs.select("taxon", "contig", "features", "coverage", "row_pos").groupBy("taxon").applyInPandas(run, "taxon string, contig string, first string")


def reindex_bins(rows: DataFrame, start: int = 0, width: int = 4, order: tuple[str, ...] = ("taxon", "cluster")) -> DataFrame:
    """rows of clusters renamed bin_0001 and so on in the given order, after start others."""
    names = rows.filter("cluster > 0").select(*order).distinct()
    number = F.row_number().over(Window.orderBy(*order)) + start  # a row for each cluster
    return rows.join(names.select(*order, zero_padded("bin_", number, width).alias("bin")), list(order), "left")


class Checkpoints:
    """Finished taxa of a long run, a Parquet folder for each rank and taxon, under a hash of the parameters, so that a changed parameter starts anew."""

    def __init__(self, spark, folder: str, parameters: dict):
        import hashlib
        import json

        self.spark, self.parameters = spark, json.dumps(parameters, sort_keys=True)
        self.path = f"{folder.rstrip('/')}/{hashlib.sha256(self.parameters.encode()).hexdigest()[:16]}"

    def write(self, rank: str, rows: DataFrame) -> None:
        rows.withColumn("rank", F.lit(rank)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("rank", "taxon").parquet(self.path)

    def read(self, rank: str | None = None) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            rows = self.spark.read.parquet(self.path)
        except AnalysisException:
            return None
        return rows.filter(F.col("rank") == rank) if rank else rows

    def finished(self, rank: str) -> set[str]:
        rows = self.read(rank)
        return {r.taxon for r in rows.select("taxon").distinct().collect()} if rows is not None else set()


def guided_binning(contigs: DataFrame, expected: int, limits: Limits = Limits(), method: str = "dbscan", reverse_ranks: bool = False, start_rank: str = "superkingdom", max_partition: int | None = None, embed=None, store: Checkpoints | None = None, strict: bool = True) -> DataFrame:  # noqa: B008
    """(contig, cluster, metrics) by rounds over the ranks, coarse to fine or the other way: each taxon's contigs that have no bin yet are clustered.

    max_partition: taxa with more contigs that have no bin yet are left to finer ranks. embed: a function of a rank's contigs, all that are classified there and those
    to be clustered, that gives the second new features.
    store: where each rank's clusters are kept, so that a run that is started again goes on after the last finished rank.
    strict: a run in which no cluster passes is an error; else its contigs come back without a bin.
    """
    spark, path = contigs.sparkSession, scratch(contigs.sparkSession, "contigs")
    contigs.write.parquet(path)  # each rank reads them again
    contigs = spark.read.parquet(path)
    if contigs.filter(F.size("markers") > 0).isEmpty():
        raise NoMarkersError("no contig has a marker: clusters cannot be judged")
    if contigs.limit(2).count() < 2:
        raise BinningError("there are not enough contigs to bin")
    ranks = list(RANKS if reverse_ranks else reversed(RANKS))
    ranks = ranks[: ranks.index(start_rank) + 1] if reverse_ranks else ranks[ranks.index(start_rank) :]
    out, found = None, 0
    for rank in ranks:
        left = contigs.join(out.select("contig"), "contig", "left_anti") if out is not None else contigs
        left = left.filter(F.col(rank) != UNCLASSIFIED).withColumn("taxon", F.col(rank))
        if max_partition:
            fits = left.groupBy("taxon").count().filter(F.col("count") <= max_partition).select("taxon")
            left = left.join(fits, "taxon", "left_semi")
        if embed:
            left = embed(contigs.filter(F.col(rank) != UNCLASSIFIED), left)
        if store and (kept := store.read(rank)) is not None and not kept.isEmpty():
            new = kept.drop("rank")
        else:
            with batches_of(spark, 1000):
                new = checkpoint(cluster_groups(left, expected, limits, method))
            if store:
                store.write(rank, new)
        new = new.filter("cluster > 0")
        new = checkpoint(reindex_bins(new, found).select("contig", F.col("bin").alias("cluster"), *METRICS))
        found += new.select("cluster").distinct().count()
        out = new if out is None else checkpoint(out.unionByName(new))
    if not found and strict:
        raise BinningError("no cluster was recovered")
    return contigs.select("contig").join(out, "contig", "left")
