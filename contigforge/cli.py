"""Commands: python -m contigforge.cli COMMAND ...; tables are tab-separated with a header, sequences FASTA."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import __version__
from .operators import benchmark, clustering, contigs, coverage, embedding, kmers, legacy, markers, recruitment, relational, summary, taxonomy
from .schemas import COVERAGE, LCA, RANKS, VOTES
from .session import get_session
from .sources import readers, writers


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return readers.tsv(spark, path, schema) if schema else spark.read.csv(path, sep="\t", header=True, inferSchema=True)


def _tree(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.build_tree(readers.nodes_dump(spark, f"{folder}/nodes.dmp"), readers.names_dump(spark, f"{folder}/names.dmp"))


def _features(rows: DataFrame) -> DataFrame:
    """x_ columns as one array."""
    names = [c for c in rows.columns if c.startswith("x_")]
    return rows.withColumn("features", F.array(*[F.col(c).cast("double") for c in names])).drop(*names) if names else rows


def length_filter(spark, a) -> None:
    writers.fasta(contigs.length_filter(readers.fasta(spark, a.assembly), a.cutoff), a.output)


def count_kmers(spark, a) -> None:
    counts = kmers.count(readers.fasta(spark, a.fasta), a.size)
    if a.counts:
        writers.tsv(kmers.wide(counts, a.size), a.counts)
    normal = kmers.normalize(counts, a.norm_method, a.size)
    rows = kmers.pca(normal if a.norm_method == "ilr" else kmers.features(normal), a.pca_dimensions)
    rows = embedding.embed(rows, a.embedding_dimensions, a.embedding_method, seed=a.seed)
    writers.tsv(rows.select("contig", *[F.col("features")[i].alias(f"x_{i + 1}") for i in range(a.embedding_dimensions)]), a.output)


def get_coverage(spark, a) -> None:
    writers.tsv(coverage.get(spark, readers.fasta(spark, a.assembly), a.from_spades, None, a.bed, a.bam, a.sam, a.reads), a.output)


def get_markers(spark, a) -> None:
    hits = markers.apply_cutoffs(readers.tblout(spark, a.hmmscan), readers.tsv(spark, a.cutoffs, "accession string, cutoff double"))
    from .functions.sequences import orf_contig

    writers.tsv(hits.select(orf_contig(F.col("orf")).alias("contig"), "orf", "sacc", "sname", "evalue", "score"), a.output)


def lca(spark, a) -> None:
    writers.tsv(taxonomy.blast_to_lca(readers.blast6(spark, a.blast), readers.accession_taxids(spark, a.accessions, a.full), _tree(spark, a.dbdir), readers.accession_taxids(spark, a.dead) if a.dead else None), a.lca_output)


def majority_vote(spark, a) -> None:
    tree = _tree(spark, a.dbdir)
    path = taxonomy.paths(tree)
    writers.tsv(taxonomy.majority_vote(taxonomy.vote_counts(_read(spark, a.lca, LCA), tree, path), tree, path), a.output)


def ranks(spark, a) -> None:
    ranked = taxonomy.add_ranks(_read(spark, a.votes, VOTES), _tree(spark, a.dbdir))
    writers.tsv(ranked, f"{a.output}/taxonomy")
    if a.split_rank:
        writers.rank_fasta(readers.fasta(spark, a.assembly), ranked, a.split_rank, f"{a.output}/by_{a.split_rank}")


def _bin_input(spark, a) -> tuple[DataFrame, DataFrame]:
    rows = relational.annotate(_features(_read(spark, a.kmers)), _read(spark, a.coverages, COVERAGE), _read(spark, a.gc_content).select("contig", "gc_content", "length"), _read(spark, a.taxonomy))
    marks = _read(spark, a.markers).select("contig", "sacc")
    rows = taxonomy.filter_taxonomy(rows, a.rank_filter, a.rank_name_filter).join(markers.markers_list(marks), "contig", "left")
    return rows.withColumn("row_pos", F.xxhash64("contig")), marks


def binning(spark, a, most: int | None = None, embed=None) -> None:
    rows, marks = _bin_input(spark, a)
    limits = clustering.Limits(a.completeness, a.purity, a.cov_stddev_limit, a.gc_stddev_limit)
    bins = clustering.guided_binning(rows, marks.select("sacc").distinct().count(), limits, a.clustering_method, a.reverse_ranks, a.starting_rank, most, embed)
    writers.tsv(bins, a.output_binning)
    writers.tsv(rows.drop("markers", "features", "row_pos").join(bins, "contig", "left"), a.output_main)


def binning_ldm(spark, a) -> None:
    binning(spark, a, a.max_partition_size, lambda every, rows: embedding.reembed(every, rows, a.embedding_dimensions, a.pca_dimensions, seed=a.seed))


def loginfo(spark, a) -> None:
    writers.tsv(legacy.log_rollup(readers.binning_log(spark, a.log)), a.output)


def binning_summary(spark, a) -> None:
    rows = _read(spark, a.binning_main)
    writers.tsv(summary.metabin_stats(rows, _read(spark, a.markers).select("contig", "sacc")), a.output_stats)
    if a.metagenome and a.output_metabins:
        writers.cluster_fasta(readers.fasta(spark, a.metagenome), rows, a.output_metabins)


def recruit(spark, a) -> None:
    rows = recruitment.features(_features(_read(spark, a.kmers)), _read(spark, a.coverage, COVERAGE), _read(spark, a.taxonomy) if a.taxonomy else None)
    writers.tsv(recruitment.recruit(rows, _read(spark, a.binning, "contig string, cluster string"), _read(spark, a.markers).select("contig", "sacc"), a.classifier, a.num_classifications, a.confidence, a.seed), a.output)


def cami(spark, a) -> None:
    writers.biobox(_read(spark, a.predictions), a.output, a.kind, a.sample_id)


def score(spark, a) -> None:
    predicted, truth = _read(spark, a.predictions), _read(spark, a.reference)
    if a.benchmark == "clustering":
        out = benchmark.clustering_scores(benchmark.labels(predicted, truth))
    elif a.benchmark == "classification":
        out = benchmark.lineage_scores(predicted, truth, _tree(spark, a.dbdir))
    else:
        out = benchmark.binning_classification(predicted, truth)
    writers.tsv(out, a.output)


def _binning_flags(p) -> None:
    for name in ("kmers", "coverages", "gc-content", "markers", "taxonomy", "output-binning", "output-main"):
        p.add_argument(f"--{name}", required=True)
    for name, value in (("completeness", 20.0), ("purity", 95.0), ("cov-stddev-limit", 25.0), ("gc-stddev-limit", 5.0)):
        p.add_argument(f"--{name}", type=float, default=value)
    p.add_argument("--clustering-method", choices=("dbscan", "hdbscan"), default="dbscan")
    p.add_argument("--starting-rank", choices=RANKS, default="superkingdom")
    p.add_argument("--reverse-ranks", action="store_true")
    p.add_argument("--rank-filter", choices=RANKS, default="superkingdom")
    p.add_argument("--rank-name-filter", default="bacteria")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="contigforge")
    top.add_argument("--version", action="version", version=__version__)
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, f, *required: str, **optional):
        p = sub.add_parser(name)
        p.set_defaults(run=f)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        for k, v in optional.items():
            flag = "--" + k.replace("_", "-")
            p.add_argument(flag, action="store_true") if v is False else p.add_argument(flag, default=v, type=type(v) if v is not None else str)
        return p

    add("length-filter", length_filter, "assembly", "output", cutoff=3000.0)
    add("kmers", count_kmers, "fasta", "output", counts=None, size=5, norm_method="am_clr", pca_dimensions=50, embedding_method="bhsne", embedding_dimensions=2, seed=42)
    add("coverage", get_coverage, "assembly", "output", from_spades=False, bed=None, bam=None, sam=None, reads=None)
    add("markers", get_markers, "hmmscan", "cutoffs", "output")
    add("taxonomy-lca", lca, "blast", "accessions", "dbdir", "lca-output", dead=None, full=False)
    add("taxonomy-majority-vote", majority_vote, "lca", "dbdir", "output")
    add("taxonomy", ranks, "votes", "dbdir", "output", assembly=None, split_rank=None)
    _binning_flags(add("binning", binning))
    p = add("binning-ldm", binning_ldm, max_partition_size=10_000, pca_dimensions=50, embedding_dimensions=2, seed=42)
    _binning_flags(p)
    add("binning-ldm-loginfo", loginfo, "log", "output")
    add("binning-summary", binning_summary, "binning-main", "markers", "output-stats", metagenome=None, output_metabins=None)
    add("unclustered-recruitment", recruit, "kmers", "coverage", "binning", "markers", "output", taxonomy=None, classifier="decision_tree", num_classifications=10, confidence=1.0, seed=42)
    add("cami-format", cami, "predictions", "output", kind="genome_binning", sample_id="sample")
    add("benchmark", score, "predictions", "reference", "output", benchmark="clustering", dbdir=None)
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(get_session(), a)


if __name__ == "__main__":
    main()
