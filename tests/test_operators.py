"""Operators against hand-made fixtures, brute force and their invariants."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from contigforge.functions import sequences as fn
from contigforge.operators import benchmark, clustering, contigs, embedding, kmers, legacy, markers, recruitment, relational, taxonomy
from contigforge.schemas import RANKS
from contigforge.session import scratch
from contigforge.sources import readers, writers
from contigforge.streaming import compose


def test_known_lengths(spark):
    rows = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate((7237, 7237, 7231, 7229))], "contig string, length int")
    four = contigs.nx(rows, {"n10": 0.1, "n90": 0.9}).first()
    three = contigs.nx(rows.filter("length > 7229"), {"n10": 0.1, "n90": 0.9}).first()
    assert (four.n10, four.n90, three.n10, three.n90) == (7237, 7229, 7237, 7231)


def test_length_filter(spark):
    rows = spark.createDataFrame([("a", "ACGT"), ("b", "AC")], "contig string, sequence string")
    assert [r.contig for r in contigs.length_filter(rows, 3).collect()] == ["a"]
    assert contigs.length_filter(rows, 100).count() == 2
    for bad, error in (("3", TypeError), (True, TypeError), (0, ValueError), (-1, ValueError)):
        with pytest.raises(error):
            contigs.length_filter(rows, bad)


def test_scalar_functions(spark):
    r = spark.range(1).select(
        fn.reverse_complement(F.lit("AACGT")).alias("rc"), fn.gc_percent(F.lit("ggSNNaT")).alias("gc"), fn.gc_percent(F.lit("")).alias("none"), fn.header_coverage(F.lit("NODE_1_length_9_cov_22.5")).alias("cov"),
        fn.header_coverage(F.lit("contig")).alias("nocov"), fn.orf_contig(F.lit("NODE_1_cov_2.5_13")).alias("orf"), fn.taxon_name(F.lit("A b/(C)")).alias("name"), fn.zero_padded("bin_", F.lit(12345), 3).alias("pad"), fn.genome_accession(F.lit("/x/GCF_000001.1_y.faa")).alias("acc"),
    ).first()
    assert (r.rc, r.gc, r.none, r.cov, r.nocov, r.orf, r.name, r.pad, r.acc) == ("ACGTT", 60.0, 0.0, 22.5, None, "NODE_1_cov_2.5", "a_b__c_", "bin_12345", "GCF_000001.1")


@pytest.mark.parametrize("size", [1, 3, 5])
def test_kmers(spark, size):
    r = random.Random(size)
    rows = [(f"c{i}", "".join(r.choice("ACGTN" if i % 2 else "ACGT") for _ in range(n))) for i, n in enumerate((0, size, size + 1, 40, 700))] + [("low", "acgtacgtacgt")]
    names = kmers.canonical_kmers(size)
    assert len(names) == {1: 2, 3: 32, 5: 512}[size]
    pair, want = str.maketrans("ACGT", "TGCA"), {}
    for c, s in rows:
        for i in range(len(s) - size):
            k = s[i : i + size]
            if set(k) <= set("ACGT"):
                k = k if k in names else k.translate(pair)[::-1]
                want[c, k] = want.get((c, k), 0) + 1
    frame = spark.createDataFrame(rows, "contig string, sequence string")
    counts = kmers.count(frame, size)
    assert {(x.contig, x.kmer): x.n for x in counts.collect()} == want
    assert kmers.wide(counts, size, frame).count() == len(rows) and len(kmers.wide(counts, size).columns) == len(names) + 1
    both = frame.withColumn("sequence", fn.reverse_complement(F.col("sequence")))
    sort = lambda df: sorted(map(tuple, df.collect()))
    assert sort(kmers.count(frame, size, True)) == sort(kmers.count(both, size, True))
    with pytest.raises(ValueError):
        kmers.normalize(counts, "other")


def test_normalisation(spark):
    counts = spark.createDataFrame([("a", "AAA", 3), ("a", "AAT", 1), ("b", "AAT", 2)], "contig string, kmer string, n long")
    got = {(r.contig, r.kmer): r.value for r in kmers.am_clr(counts).collect()}
    x = np.log([[4, 2], [1, 3]])
    for i, c in enumerate("ab"):
        for j, k in enumerate(("AAA", "AAT")):
            assert got[c, k] == pytest.approx((x[i] - x[i].mean())[j])
    sums = kmers.clr(counts, 3).groupBy("contig").agg(F.sum("value").alias("s"), F.count("*").alias("n")).collect()
    assert all(abs(r.s) < 1e-9 and r.n == 32 for r in sums)
    basis = kmers._ilr_basis(32)
    assert np.allclose(basis @ basis.T, np.eye(31)) and np.allclose(basis.sum(1), 0)
    c = {r.contig: r.features for r in kmers.features(kmers.clr(counts, 3)).collect()}
    i = {r.contig: r.features for r in kmers.ilr(counts, 3).collect()}
    assert np.linalg.norm(np.subtract(c["a"], c["b"])) == pytest.approx(np.linalg.norm(np.subtract(i["a"], i["b"])))


def test_pca(spark):
    x = np.random.default_rng(1).normal(5, 1, (40, 6)) * [9, 5, 1, 1, 1, 1]
    frame = spark.createDataFrame([(f"c{i:02}", v) for i, v in enumerate(x.tolist())], "contig string, features array<double>")
    got = np.array([r.features for r in kmers.pca(frame, 2).orderBy("contig").collect()])
    y = x - x.mean(0)
    _, _, v = np.linalg.svd(y, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(y @ v[:2].T)) and np.allclose(got.mean(0), 0)
    assert kmers.pca(frame, 0).first().features == x[0].tolist() or kmers.pca(frame, 10).count() == 40


def test_tsne(spark):
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(0, 0.1, (20, 5)), r.normal(9, 0.1, (20, 5))])
    y = embedding.tsne(x, 2, rounds=200)
    a, b = y[:20], y[20:]
    assert np.linalg.norm(a.mean(0) - b.mean(0)) > 2 * max(a.std(), b.std())
    assert embedding.clamp_perplexity(10) == 2.0 and embedding.clamp_perplexity(1000) == 30.0
    frame = spark.createDataFrame([("a", [1.0])], "contig string, features array<double>")
    with pytest.raises(NotImplementedError):
        embedding.embed(frame, method="umap")
    with pytest.raises(ValueError):
        embedding.embed(frame, method="other")


@pytest.fixture(scope="module")
def tree(spark):
    """1 - 2 (superkingdom) - 3 (clade) - 4 (phylum) - 5, 6 (species); 2 - 7 (phylum)."""
    rows = [(1, 1, "root", "root"), (2, 1, "superkingdom", "bacteria"), (3, 2, "clade", "c"), (4, 3, "phylum", "p"), (5, 4, "species", "s five"), (6, 4, "species", "s six"), (7, 2, "phylum", "q")]
    return spark.createDataFrame(rows, "taxid int, parent int, rank string, name string")


def test_tree(spark, tree):
    paths = {r.taxid: r.path for r in taxonomy.paths(tree).collect()}
    assert paths[5] == [5, 4, 3, 2, 1] and paths[1] == [1]
    frame = {r.taxid: r for r in taxonomy.lineage_frame(tree).collect()}
    assert (frame[5].superkingdom, frame[5].phylum, frame[5].genus, frame[5].species) == ("bacteria", "p", "unclassified", "s five") and frame[1].superkingdom == "unclassified"
    names = {r.taxid: r.name for r in taxonomy.name_at(tree, spark.createDataFrame([(5,), (7,), (99,)], "taxid int"), "phylum").collect()}
    assert names == {5: "p", 7: "q", 99: "unclassified"}


def test_lca(spark, tree):
    path = taxonomy.paths(tree)
    sets = {"one": [5], "pair": [5, 6], "wide": [5, 7], "unknown": [99], "part": [5, 99], "three": [5, 6, 4], "none": [None]}
    taxa = spark.createDataFrame([(q, t) for q, ts in sets.items() for t in ts], "qseqid string, taxid int")
    got = {r.qseqid: r.lca for r in taxonomy.lca_sets(taxa, path).collect()}
    assert got == {"one": 5, "pair": 4, "wide": 2, "unknown": 99, "part": 1, "three": 4, "none": 1}
    assert [(r.qseqid, r.taxids) for r in taxonomy.lca_errors(taxa, path).collect()] == [("part", "5,99")]
    pairs = path.alias("a").crossJoin(path.alias("b")).select(F.col("a.taxid").alias("x"), F.col("b.taxid").alias("y"), taxonomy.lca_pair(F.col("a.path"), F.col("b.path")).alias("l"))
    found = {(r.x, r.y): r.l for r in pairs.collect()}
    assert all(found[x, y] == found[y, x] for x, y in found) and all(found[x, x] == x for x in range(1, 8)) and found[5, 7] == 2


def test_votes(spark, tree):
    lcas = [("k1_1", 5), ("k1_2", 5), ("k1_3", 7), ("k2_1", 1), ("k2_2", 1), ("k3_1", 3), ("k4_1", 5), ("k4_2", 6), ("k5_1", 5), ("k5_2", 7), ("k5_3", 7), ("k6_1", 5), ("k6_2", 1), ("k6_3", 1)]
    rows = spark.createDataFrame([(q, t, i) for i, (q, t) in enumerate(lcas)], "qseqid string, lca int, line_no int")
    votes = taxonomy.vote_counts(rows, tree)
    assert {(r.contig, r.rank, r.taxid): r.n for r in votes.filter("contig in ('k1', 'k3', 'k2')").collect()} == {("k1", "species", 5): 2, ("k1", "phylum", 7): 1, ("k3", "superkingdom", 2): 1, ("k2", "root", 1): 2}
    got = {r.contig: r.taxid for r in taxonomy.majority_vote(votes, tree).collect()}
    assert got == {"k1": 5, "k2": 1, "k3": 2, "k4": 5, "k5": 5, "k6": 5}
    strict = {r.contig: r.taxid for r in taxonomy.majority_vote(votes, tree, strict=True).collect()}
    assert strict["k4"] == 4 and strict["k5"] == 7


def test_taxids(spark, tree):
    rows = spark.createDataFrame([(5,), (50,), (60,)], "taxid int")
    merged, gone = spark.createDataFrame([(50, 7)], "old_taxid int, new_taxid int"), spark.createDataFrame([(60,)], "taxid int")
    assert {r.taxid: r.cleaned_taxid for r in taxonomy.clean_taxids(rows, tree, merged, gone).collect()} == {5: 5, 50: 7, 60: 1}
    with pytest.raises(taxonomy.TaxonomyError):
        taxonomy.clean_taxids(spark.createDataFrame([(77,)], "taxid int"), tree, merged, gone)
    texts = spark.createDataFrame([("12",), ("12.0",), ("12.5",), ("x",), ("-1",), (None,)], "t string").select(taxonomy.read_taxid(F.col("t")).alias("v"))
    assert [r.v for r in texts.collect()] == [12, 12, None, None, None, None]


def test_accessions(spark):
    hits = spark.createDataFrame([("q", "A1.1"), ("q", "A2.1"), ("q", "A3"), ("q", "A4.1")], "qseqid string, sseqid string")
    live = spark.createDataFrame([("A1", "A1.1", 5), ("A3", "A3.2", 6)], "accession string, accession_version string, taxid int")
    dead = spark.createDataFrame([("A1", "A1.1", 9), ("A2", "A2.1", 7)], "accession string, accession_version string, taxid int")
    assert {r.sseqid: r.raw_taxid for r in taxonomy.accession_taxids(hits, live, dead).collect()} == {"A1.1": 5, "A2.1": 7, "A3": 6, "A4.1": 1}
    scored = spark.createDataFrame([("q", 100.0), ("q", 90.0), ("q", 89.9)], "qseqid string, bitscore double")
    assert taxonomy.top_hits(scored).count() == 2


def test_filters(spark):
    rows = spark.createDataFrame([("a", "Some (Thing)"), ("b", "other")], "contig string, phylum string")
    assert [r.contig for r in taxonomy.filter_taxonomy(rows, "phylum", "some__thing_").collect()] == ["a"]
    with pytest.raises(KeyError):
        taxonomy.filter_taxonomy(rows, "class", "x")
    with pytest.raises(ValueError):
        taxonomy.filter_taxonomy(rows, "phylum", "x")
    bins = spark.createDataFrame([("a", "x", 1.0, 50.0), ("b", "x", 2.0, 51.0), ("c", "y", 1.0, 50.0), ("d", None, 1.0, 50.0), ("e", "z", 1.0, 1.0), ("f", "z", 1.0, 1.0)], "contig string, cluster string, coverage double, gc_content double")
    marks = spark.createDataFrame([("a", "m1"), ("b", "m1"), ("b", "m2"), ("c", "m1"), ("outside", "m9")], "contig string, sacc string")
    got = {r.cluster: r for r in markers.bin_metrics(bins, marks).collect()}
    assert got["x"].completeness == pytest.approx(200 / 3) and got["x"].purity == 50 and got["y"].coverage_stddev is None and got["z"].purity is None and got["z"].completeness == 0
    assert markers.metric_filter(markers.bin_metrics(bins, marks), purity=50).count() == 1
    with pytest.raises(KeyError):
        markers.metric_filter(bins)


def components_by_search(x, eps):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= eps
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if label[i] < 0:
            stack, label[i] = [i], i
            while stack:
                for j in np.flatnonzero(d[stack.pop()] & (label < 0)):
                    label[j] = i
                    stack.append(j)
    return pd.factorize(label)[0]


@pytest.mark.parametrize("eps", [0.1, 0.3, 0.7, 1.5])
def test_dbscan(eps):
    x = np.random.default_rng(3).normal(0, 1, (200, 2))
    assert (clustering.dbscan(x, eps) == components_by_search(x, eps)).all()
    line = np.array([[0.0], [1.0], [2.0], [3.5]])
    assert clustering.dbscan(line, 1.0).tolist() == [0, 0, 0, 1] and clustering.dbscan(line[:0], 1).tolist() == []


def test_hdbscan():
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(c, 0.1, (30, 2)) for c in (0, 5, 10)] + [[[100.0, 100.0]]])
    labels = clustering.hdbscan(x, 10, 3)
    assert len(set(labels[:90])) == 3 and labels[90] == -1 and all(len(set(labels[i : i + 30])) == 1 for i in (0, 30, 60))
    one = clustering.hdbscan(r.normal(0, 1, (20, 2)), 15, 1)
    assert set(one.tolist()) <= {0, -1} and clustering.hdbscan(x[:1], 2).tolist() == [-1]


def test_sweep_objective():
    """The median counts clusters, not contigs: nine contigs at 30 % and three at 90 % give 60."""
    n = 12
    frame = pd.DataFrame({"contig": [f"c{i}" for i in range(n)], "features": [[0.0 if i < 9 else 50.0, 0.0] for i in range(n)], "coverage": 1.0, "gc_content": 50.0, "markers": [[f"m{i}"] if i < 3 else [f"m{k}" for k in range((i - 9) * 3, (i - 8) * 3)] if i >= 9 else [] for i in range(n)]})
    group = clustering.Group(frame, 10)
    rows, labels = np.arange(n), np.array([0] * 9 + [1] * 3)
    metrics = group.metrics(rows, labels)
    assert metrics["completeness"].tolist() == [30.0, 90.0] and group._median(metrics, clustering.Limits()) == 60.0
    assert group._median(metrics, clustering.Limits(completeness=95)) == -np.inf


def sweep_by_rule(group, limits, method):
    """The sweep as the rules state it, over whole clusterings of each round."""
    rows, x = np.arange(len(group.frame)), group.x
    best, out, size, samples, most, eps, step, seen, zeros, n = -np.inf, None, 2, 1, 10_000, 0.3, 0.1, {}, 0, 2
    while n > 1:
        labels = components_by_search(x, eps) if method == "dbscan" else clustering.hdbscan(x, size, samples)
        good = [m for _, m in group.metrics(rows, labels).iterrows() if m.completeness >= limits.completeness and m.purity >= limits.purity and m.coverage_stddev <= limits.coverage_stddev and m.gc_content_stddev <= limits.gc_content_stddev]
        value = sorted(m.completeness for m in good)
        median = (value[(len(value) - 1) // 2] + value[len(value) // 2]) / 2 if value else -np.inf
        if median >= best:
            best, out = median, labels
        n = len({k for k in labels.tolist() if k >= 0})
        if method == "dbscan":
            seen[n] = seen.get(n, 0) + 1
            step = step * 10 if seen[n] > 10 else step
            zeros += median == 0
            if zeros >= 10:
                break
            eps += step
        else:
            if size >= most:
                size, samples = 2, samples + 1
            else:
                size += 10
            size += 0 if value else 100
            most *= 2 if samples >= 10 else 1
    return out


@pytest.mark.parametrize("method", ["dbscan", "hdbscan"])
def test_sweeps_follow_the_rules(method):
    r = np.random.default_rng(8)
    limits = clustering.Limits(20, 60, 25, 5)
    for _ in range(60):
        n = int(r.integers(2, 60))
        centre = r.normal(0, 4, (4, 2))
        frame = pd.DataFrame({"contig": [f"c{i}" for i in range(n)], "features": [(centre[r.integers(4)] + r.normal(0, 0.4, 2)).tolist() for _ in range(n)], "coverage": r.normal(1, 0.2, n), "gc_content": r.normal(50, 2, n), "markers": [[f"m{k}" for k in r.choice(10, r.integers(0, 3), replace=False)] for _ in range(n)]})
        group = clustering.Group(frame, 10)
        got = getattr(group, f"sweep_{method}")(np.arange(n), limits)
        assert got.tolist() == sweep_by_rule(group, limits, method).tolist()


def test_binning_needs_markers_and_contigs(spark):
    schema = "contig string, features array<double>, coverage double, gc_content double, markers array<string>, superkingdom string, row_pos int"
    none = spark.createDataFrame([("a", [0.0], 1.0, 50.0, [], "b", 0), ("b", [0.0], 1.0, 50.0, None, "b", 1)], schema)
    with pytest.raises(clustering.NoMarkersError):
        clustering.guided_binning(none, 3)
    with pytest.raises(clustering.BinningError):
        clustering.guided_binning(spark.createDataFrame([("a", [0.0], 1.0, 50.0, ["m"], "b", 0)], schema), 3)


def test_cluster_taxonomy_of_strains(spark):
    """A short contig of a strain doesn't outvote a long one of another species."""
    from contigforge.operators import summary, taxonomy

    tree = spark.createDataFrame([(1, 1, "no rank", "root"), (2, 1, "superkingdom", "Bacteria"), (3, 2, "genus", "A"), (4, 3, "species", "A a"), (5, 4, "strain", "A a x"), (6, 3, "species", "A b")], "taxid int, parent int, rank string, name string")
    bins = spark.createDataFrame([("c1", "bin", 5, 100, 0), ("c2", "bin", 6, 100_000, 1)], "contig string, cluster string, taxid int, length long, contig_order long")
    assert summary.metabin_taxonomy(bins, taxonomy.lineage_frame(tree), tree).first().taxid == 6


def test_binning(spark):
    r = np.random.default_rng(5)
    rows, k = [], 0
    for taxon, centre in (("p1", 0), ("p1", 9), ("p2", 0)):
        for j in range(6):
            rows.append((f"c{k:02}", (r.normal(centre, 0.05, 2)).tolist(), 1.0 + j / 100, 50.0 + j / 100, [f"m{j}"], "b", taxon, k))
            k += 1
    schema = "contig string, features array<double>, coverage double, gc_content double, markers array<string>, superkingdom string, phylum string, row_pos int"
    frame = spark.createDataFrame(rows, schema).withColumns({x: F.lit("unclassified") for x in RANKS if x not in ("superkingdom", "phylum")})
    for method in ("dbscan", "hdbscan"):
        got = {x.contig: x.cluster for x in clustering.guided_binning(frame, 6, method=method, start_rank="phylum").collect()}
        groups = [{got[f"c{i:02}"] for i in range(s, s + 6)} for s in (0, 6, 12)]
        if method == "dbscan":
            assert all(len(g) == 1 and None not in g for g in groups) and len(set.union(*groups)) == 3
        else:  # leaves may be smaller, but none mixes groups
            assert all(not (a & b) - {None} for i, a in enumerate(groups) for b in groups[:i]) and set.union(*groups) - {None}
    with pytest.raises(clustering.BinningError):
        clustering.guided_binning(frame, 6000)
    store = clustering.Checkpoints(spark, scratch(spark, "resume"), {"a": 1})
    assert store.finished("phylum") == set()
    store.write("phylum", spark.createDataFrame([("p1", "c1")], "taxon string, contig string"))
    store.write("phylum", spark.createDataFrame([("p2", "c2")], "taxon string, contig string"))
    assert store.finished("phylum") == {"p1", "p2"} and store.finished("class") == set()


def test_recruitment(spark):
    r = np.random.default_rng(6)
    rows = [(f"c{i}", r.normal(9 * (i % 2), 0.1, 3).tolist()) for i in range(60)]
    features = spark.createDataFrame(rows, "contig string, features array<double>")
    bins = spark.createDataFrame([(f"c{i}", None if i >= 50 else f"b{i % 2}") for i in range(60)], "contig string, cluster string")
    marks = spark.createDataFrame([(f"c{i}", f"m{i}") for i in range(60)], "contig string, sacc string")
    got = {x.contig: x.recruited_cluster for x in recruitment.recruit(features, bins, marks, n=3).collect()}
    assert got == {f"c{i}": f"b{i % 2}" for i in range(60)}
    taken = spark.createDataFrame([("c50", "b0"), ("c51", "b1")], "contig string, cluster string")
    same = marks.filter("contig <> 'c50'").union(spark.createDataFrame([("c50", "m0")], "contig string, sacc string"))
    assert [x.contig for x in recruitment.uncontaminated(taken, bins, same).collect()] == ["c51"]
    votes = spark.createDataFrame([("a", "y", 5), ("a", "x", 5), ("b", "x", 4)], "contig string, cluster string, votes long")
    assert [tuple(x) for x in recruitment.confident(votes, 10, 0.5).collect()] == [("a", "x")]
    with pytest.raises(ValueError):
        recruitment.recruit(features, bins, marks, "other")


def test_indices(spark):
    r = random.Random(7)
    rows = [(f"c{i}", f"p{r.randrange(4)}", f"t{r.randrange(3)}") for i in range(40)]
    pairs = spark.createDataFrame(rows, "contig string, p string, t string")
    got = benchmark.clustering_scores(pairs).first()
    same = lambda k: [[x[k] == y[k] for y in rows] for x in rows]
    p, t, n = np.array(same(1)), np.array(same(2)), len(rows)
    up = np.triu_indices(n, 1)
    tp, fp, fn_ = (p & t)[up].sum(), (p & ~t)[up].sum(), (~p & t)[up].sum()
    total = n * (n - 1) / 2
    expected, most = (tp + fp) * (tp + fn_) / total, (2 * tp + fp + fn_) / 2
    assert got.ari == pytest.approx((tp - expected) / (most - expected)) and got.fowlkes_mallows == pytest.approx(tp / math.sqrt((tp + fp) * (tp + fn_)))
    perfect = benchmark.clustering_scores(pairs.withColumn("p", F.concat(F.lit("x"), "t"))).first()
    assert all(x == pytest.approx(1) for x in perfect)
    assert benchmark.adjusted_mutual_information(pairs.withColumn("p", F.col("t"))) == pytest.approx(1) and abs(benchmark.adjusted_mutual_information(pairs)) < 0.3
    by = benchmark.clustering_scores(pairs.withColumn("dataset", F.lit("d")), ["dataset"]).first()
    assert by.dataset == "d" and by.ari == pytest.approx(got.ari)


def test_graph_and_ranges(spark):
    edges = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(40)] + [("x", "y"), ("z", "z")], "u string, v string")
    got = {r.node: r.component for r in legacy.graph_components(edges).collect()}
    assert got == {f"n{i:03}": "n000" for i in range(41)} | {"x": "x", "y": "x"}
    reads = spark.createDataFrame([(9,), (10,), (5000,), (100,)], "number int")
    ranges = spark.createDataFrame([("a", 9, 10), ("b", 100, 9000)], "name string, start int, end int")
    assert sorted((r.number, r.name) for r in legacy.in_ranges(reads, ranges).collect()) == [(9, "a"), (10, "a"), (100, "b"), (5000, "b")]
    cells = spark.createDataFrame([("s1", "b1", 9), ("s2", "b1", 8), ("s2", "b2", 1)], "species string, bin string, n int")
    assert legacy.claim_bins(cells) == [("s1", "b1"), ("s2", "b2")]


def test_files(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">c1 with > inside\nACG\nT\n>c2\nGG\n")
    rows = {r.contig: r for r in readers.fasta(spark, str(tmp_path / "a.fasta")).collect()}
    assert rows["c1"].sequence == "ACGT" and rows["c1"].description == "c1 with > inside" and rows["c2"].sequence == "GG"
    assert sorted(map(tuple, readers.fasta_folder(spark, str(tmp_path / "*.fasta")).collect())) == [("a", "c1"), ("a", "c2")]
    sheet = tmp_path / "sheet.csv"
    head = "sample,assembly,fastq_1,fastq_2,coverage_tab,cov_from_assembly\n"
    sheet.write_text(head + "s1,a.fna,,,,spades\ns2,b.fna,r1.fq,r2.fq,,0\n")
    assert readers.samplesheet(spark, str(sheet)).count() == 2
    for bad in ("s1,a.fna,,,,spades\ns1,b.fna,,,,spades\n", "s 1,a.fna,,,,spades\n", "s1,,,,,spades\n", "s1,a.fna,,,,0\n"):
        sheet.write_text(head + bad)
        with pytest.raises(ValueError):
            readers.samplesheet(spark, str(sheet))
    bins = spark.createDataFrame([("c1", "b1"), ("c2", None)], "contig string, cluster string")
    out = str(tmp_path / "bins")
    writers.cluster_fasta(readers.fasta(spark, str(tmp_path / "a.fasta")), bins, out)
    assert {p.name for p in (tmp_path / "bins").iterdir() if p.is_dir()} == {"cluster=b1", "cluster=unclustered"}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        writers.cluster_fasta(readers.fasta(spark, str(tmp_path / "a.fasta")), bins, out)
    with pytest.raises(NotImplementedError):
        writers.biobox_lines(bins, "profiling", "s")
    assert relational.stack(bins, bins.select("contig")).columns == ["cluster", "contig"]
    with pytest.raises(ValueError):
        relational.annotate(bins, bins, how="left")


def test_streamed_counts(spark, tmp_path):
    frame = spark.createDataFrame([("c1", "ACGTACGTAC"), ("c2", "GGGGGGGG")], "contig string, sequence string")
    frame.write.parquet(str(tmp_path / "in"))
    compose.count_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), 3).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("contig", "kmer", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kmers.count(frame, 3).collect()))


def test_large_binning_finer_ranks(spark, monkeypatch):
    """A taxon over the limit at every coarse rank is clustered lower down, and the limit is the reference's."""
    from contigforge.plans import registry

    whole, seen = clustering.guided_binning, {}

    def guided(rows, expected, limits, **other):
        coarse = min(r["count"] for k in ("superkingdom", "phylum") for r in rows.groupBy(k).count().collect())
        seen.update(rows=rows, limit=other["max_partition"])
        return whole(rows, expected, limits, max_partition=coarse - 1)

    monkeypatch.setattr(clustering, "guided_binning", guided)
    got = registry.queries()["binning_large_data"](spark, "/root/testdata/sf0.01")
    assert seen["limit"] == 10000
    assert got.count() == seen["rows"].count() and got.filter("cluster is not null").count() > 0


def test_query_without_clusters(spark, tmp_path):
    """where no cluster passes, the query gives every contig without a bin; the operator still raises unless it is told not to."""
    from contigforge.plans import registry

    for t in ("lineitem", "embeddings"):
        rows = spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
        if t == "lineitem":  # one contig with markers, and far more markers than it has
            own = rows.filter("l_suppkey = 7")
            rows = own.union(own.crossJoin(spark.range(99).select()).withColumns({"l_partkey": F.monotonically_increasing_id() + 10**6, "l_suppkey": F.lit(10**6).cast("long")}))
        rows.write.parquet(str(tmp_path / f"{t}.parquet"))
    got = registry.queries()["binning_dbscan"](spark, str(tmp_path)).collect()
    assert len(got) == 500 == len({r.contig for r in got}) and all(r.cluster is None and r.completeness is None and r.purity is None for r in got)


def test_tsne_of_many_contigs():
    """memory doesn't take the square of a large group; the grid sums what all pairs give, and near neighbours stay near."""
    import tracemalloc

    r = np.random.default_rng(12)
    for scale in (1, 8, 30):
        y = r.normal(0, scale, (1500, 2))
        (total, force), (grid_total, grid_force) = embedding._repulsion(y), embedding.Grid()(y)
        assert grid_total == pytest.approx(total, rel=2e-3) and np.linalg.norm(grid_force - force) < 0.02 * np.linalg.norm(force)
    label = np.arange(4000) % 8
    x = r.normal(0, 10, (8, 6))[label] + r.normal(0, 0.3, (4000, 6))
    tracemalloc.start()
    y = embedding.tsne(x, 2, rounds=150)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4000**2 * 8 * 2
    near = ((y[:200, None] - y[None]) ** 2).sum(2)
    near[np.arange(200), np.arange(200)] = np.inf
    assert (label[near.argmin(1)] == label[:200]).mean() > 0.99
    assert embedding.tsne(x[:1100], 3, rounds=20).shape == (1100, 3) and np.isfinite(embedding.tsne(np.zeros((1100, 3)), 2, rounds=20)).all()


def test_tsne_of_whole_vectors(spark, tmp_path, monkeypatch):
    """F1 of round 3: the query embeds whole vectors with the rounds that the operator has by itself, so that contigs which differ only in the last numbers come apart."""
    from contigforge.plans import registry

    path = str(tmp_path / "embeddings.parquet")
    rows = [(i, [0.0] * 40 + [5.0 * (i // 30) + 0.01 * (i * j % 7) for j in range(24)], 3) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(path)
    seen, embed = [], embedding.embed
    monkeypatch.setattr(embedding, "embed", lambda points, *a, **b: seen.append((points, b)) or embed(points, *a, **b))
    got = {int(r.contig[1:]): r.features for r in registry.queries()["tsne_embedding"](spark, str(tmp_path)).collect()}
    points, options = seen[0]
    assert {int(r.contig[1:]): r.features for r in points.collect()} == {r.vec_id: r.embedding for r in spark.read.parquet(path).collect()}
    assert "rounds" not in options and sorted(got) == list(range(60))
    y = np.array([got[i] for i in range(60)])
    a, b = y[:30], y[30:]
    assert np.linalg.norm(a.mean(0) - b.mean(0)) > 2 * max(a.std(), b.std())


def test_grid_with_rows_far_away():
    """F1 of round 3: rows far from the others are summed by pairs and leave the grid small, also after they have come back."""
    r, grid = np.random.default_rng(13), embedding.Grid()
    y = r.normal(0, 8, (1500, 2))
    for away in (250.0, 4000.0, 0.0):
        y[:20] = away + r.normal(0, 1, (20, 2))
        (total, force), (grid_total, grid_force) = embedding._repulsion(y), grid(y)
        assert grid_total == pytest.approx(total, rel=2e-3) and np.linalg.norm(grid_force - force) < 0.02 * np.linalg.norm(force)
        assert 0 < grid.size <= 256


def test_groups_are_dealt_over_tasks(spark):
    """small rows can be much work, so that groups must not end in one task."""
    rows = spark.createDataFrame([(f"c{i}", f"t{i % 8}", [float(i), float(i * i % 7)]) for i in range(80)], "contig string, taxon string, features array<double>")
    got = embedding.embed(rows, by="taxon", rounds=2).select("taxon", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(got) == 8 and len({r.p for r in got}) > 1


def test_sweep_judges_a_cluster_once(monkeypatch):
    """rounds of the sweep look only at clusters that have changed."""
    looked, metrics = [], clustering.Group.metrics
    monkeypatch.setattr(clustering.Group, "metrics", lambda self, rows, labels: looked.append(int((labels >= 0).sum())) or metrics(self, rows, labels))
    x = [[20.0 * (i // 10) + 0.1 * (i % 10), 0.0] for i in range(100)]
    frame = pd.DataFrame({"contig": [f"c{i:03}" for i in range(100)], "features": x, "coverage": 1.0, "gc_content": 50.0, "markers": [[f"m{i % 10}"] for i in range(100)]})
    labels = clustering.Group(frame, 10).sweep_dbscan(np.arange(100), clustering.Limits())
    assert labels.tolist() == [i // 10 for i in range(100)] and sum(looked) <= 200


def test_marker_counts_by_blocks(monkeypatch):
    """codes hold over batches, and counts don't depend on how many markers are looked at together."""
    import pyarrow as pa

    codes = clustering.Codes()
    for batch in ([["a", "b"], None, ["c", None]], [[], ["b", "a", "z"]]):
        codes.add(pa.array(batch, pa.list_(pa.string())))
    many, code = codes.result()
    assert many.tolist() == [2, 0, 2, 0, 3] and code[0] == code[5] and code[1] == code[4] and len(set(code.tolist())) == 5
    r = np.random.default_rng(13)
    frame = pd.DataFrame({"contig": [f"c{i}" for i in range(50)], "features": [[0.0]] * 50, "coverage": r.normal(1, 1, 50), "gc_content": 50.0, "markers": [[f"m{k}" for k in r.choice(9, r.integers(0, 5), replace=False)] for _ in range(50)]})
    labels = r.integers(-1, 6, 50)
    got = []
    for block in (1, 7, 10**6):
        monkeypatch.setattr(clustering, "BLOCK", block)
        got.append(clustering.Group(frame, 9).metrics(np.arange(50), labels))
    for c in range(6):
        times = pd.Series([m for ms in frame["markers"][labels == c] for m in ms]).value_counts()
        for m in got:
            assert m.loc[c, "completeness"] == pytest.approx(len(times) * 100 / 9) and m.loc[c, "purity"] == pytest.approx((times == 1).sum() * 100 / len(times))


def test_one_tree_for_all_cluster_sizes(monkeypatch):
    """a sweep of HDBSCAN grows its tree once for each number of samples."""
    grown, tree = [], clustering.spanning_tree
    monkeypatch.setattr(clustering, "spanning_tree", lambda *a: grown.append(1) or tree(*a))
    r = np.random.default_rng(14)
    x = np.concatenate([r.normal(9 * c, 0.3, (60, 2)) for c in range(4)])
    frame = pd.DataFrame({"contig": [f"c{i:03}" for i in range(240)], "features": x.tolist(), "coverage": 1.0, "gc_content": 50.0, "markers": [[f"m{i % 60}"] for i in range(240)]})
    labels = clustering.Group(frame, 60).sweep_hdbscan(np.arange(240), clustering.Limits(5, 10))
    assert len(set(labels.tolist()) - {-1}) > 1 and len(grown) == 1


def test_combined_genomes_without_a_file_each(spark, tmp_path, monkeypatch):
    """an archive gives what a folder of genome files gives, and the query doesn't write a folder for each genome."""
    from contigforge.plans import registry

    rows = spark.createDataFrame([(f"GCF_{i % 3:09}.1_x", f"c{i}", "ACGT" * 5 * (i + 1)) for i in range(8)], "genome string, contig string, sequence string")
    writers.fasta_by(rows, "genome", str(tmp_path / "files"))
    writers.fasta_archive(rows, "genome", str(tmp_path / "archive"))
    got = sorted(map(tuple, readers.combined_archive(spark, str(tmp_path / "archive")).collect()))
    assert got == sorted(map(tuple, readers.combined_fasta(spark, str(tmp_path / "files/*")).collect())) and len(got) == 8
    assert sorted(x[:2] for x in got) == sorted((f"GCF_{i % 3:09}.1", f"GCF_{i % 3:09}.1 c{i}") for i in range(8)) and {len(x[2]) for x in got} == {20 * (i + 1) for i in range(8)}
    monkeypatch.setattr(registry, "scratch", lambda spark, name: str(tmp_path / name))
    assert registry.queries()["combined_genomes"](spark, "/root/testdata/sf0.01").count() == 1000
    assert not [p for p in (tmp_path / "genomes").iterdir() if p.is_dir()]
