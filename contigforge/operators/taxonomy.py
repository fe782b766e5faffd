"""Taxonomy: lineages as root paths, accession lookup, lowest common ancestors and contig votes.

A tree is a table (taxid, parent, rank, name); the root is its own parent. Lineages are made once, by joins that double the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequences import orf_contig
from ..schemas import RANKS, ROOT, UNCLASSIFIED
from ..session import checkpoint


class TaxonomyError(ValueError):
    """A taxid that is not positive and whole, or that the tree does not know."""


def read_taxid(column: Column) -> Column:
    """Text or number as a taxid: '12.0' is 12; null for what is not whole and above 0."""
    x = column.cast("string").try_cast("double")
    return F.when((x == F.floor(x)) & (x > 0), x.cast("int"))


def build_tree(nodes: DataFrame, names: DataFrame) -> DataFrame:
    rows = nodes.join(names, "taxid", "left")
    return rows.select("taxid", "parent", F.lower("rank").alias("rank"), F.coalesce(F.lower("name"), F.lit(UNCLASSIFIED)).alias("name"))


def paths(tree: DataFrame) -> DataFrame:
    """(taxid, path): the taxids from a taxon up to the root. Each round doubles the length of unfinished paths, so their number is the logarithm of the depth."""
    now = tree.select("taxid", F.when(F.col("taxid") == F.col("parent"), F.array("taxid")).otherwise(F.array("taxid", "parent")).alias("path"))
    now = now.select("taxid", "path", F.element_at("path", -1).alias("top"))
    while True:
        ends = now.select(F.col("taxid").alias("top"), F.col("path").alias("more"), F.col("top").alias("new_top"))
        joined = now.join(ends, "top")
        now = checkpoint(joined.select("taxid", F.when(F.col("top") == F.col("new_top"), F.col("path")).otherwise(F.concat("path", F.slice("more", 2, F.size("more")))).alias("path"), F.col("new_top").alias("top"), (F.col("top") != F.col("new_top")).alias("moved")))
        if now.filter("moved").isEmpty():
            return now.select("taxid", "path")


def lineage_rows(tree: DataFrame, path: DataFrame | None = None, canonical: bool = True) -> DataFrame:
    """(taxid, ancestor, rank, name, depth): a row for each ancestor, itself included, without the root; of the canonical ranks alone unless all are asked for. depth counts from the root."""
    path = paths(tree) if path is None else path
    rows = path.select("taxid", F.size("path").alias("_n"), F.posexplode("path").alias("_i", "ancestor")).filter(F.col("ancestor") != ROOT)
    known = tree.select(F.col("taxid").alias("ancestor"), "rank", "name")
    rows = rows.join(known, "ancestor").select("taxid", "ancestor", "rank", "name", (F.col("_n") - 1 - F.col("_i")).alias("depth"))
    return rows.filter(F.col("rank").isin(*RANKS)) if canonical else rows


def lineage_frame(tree: DataFrame, path: DataFrame | None = None) -> DataFrame:
    """A row for each taxon with the name at each of the seven ranks, unclassified where there is none."""
    rows = lineage_rows(tree, path).groupBy("taxid").pivot("rank", list(RANKS)).agg(F.first("name"))
    return tree.select("taxid").distinct().join(rows, "taxid", "left").select("taxid", *[F.coalesce(r, F.lit(UNCLASSIFIED)).alias(r) for r in reversed(RANKS)])


def name_at(tree: DataFrame, taxids: DataFrame, rank: str | None = None) -> DataFrame:
    """(taxid, name, rank, parent), or the name of the ancestor at a rank; unclassified where the tree has none."""
    if rank is None:
        return taxids.join(tree, "taxid", "left").select("taxid", F.coalesce("name", F.lit(UNCLASSIFIED)).alias("name"), F.coalesce("rank", F.lit(UNCLASSIFIED)).alias("rank"), F.coalesce("parent", F.lit(ROOT)).alias("parent"))
    rows = lineage_rows(tree).filter(F.col("rank") == rank).select("taxid", F.col("name").alias("_name"))
    return taxids.join(rows, "taxid", "left").select("taxid", F.coalesce("_name", F.lit(UNCLASSIFIED)).alias("name"))


def clean_taxids(rows: DataFrame, tree: DataFrame, merged: DataFrame, deleted: DataFrame, strict: bool = True) -> DataFrame:
    """rows with cleaned_taxid: merged ids renamed, deleted ones the root; others that the tree lacks raise, or are null if not strict."""
    known = tree.select(F.col("taxid").alias("_k"))
    m, d = merged.select(F.col("old_taxid").alias("_old"), F.col("new_taxid").alias("_new")), deleted.select(F.col("taxid").alias("_d"))
    x = rows.join(m, F.col("taxid") == F.col("_old"), "left").withColumn("_id", F.coalesce("_new", "taxid")).join(known, F.col("_id") == F.col("_k"), "left").join(d, F.col("_id") == F.col("_d"), "left")
    x = x.withColumn("cleaned_taxid", F.when(F.col("_k").isNotNull(), F.col("_id")).when(F.col("_d").isNotNull(), F.lit(ROOT)))
    if strict and (bad := x.filter("cleaned_taxid is null").select("taxid").first()) is not None:
        raise TaxonomyError(f"taxid {bad.taxid} is in none of nodes, merged and deleted: the taxonomy is out of step")
    return x.drop("_old", "_new", "_id", "_k", "_d")


def top_hits(hits: DataFrame, share: float = 0.9) -> DataFrame:
    """Hits whose score is at least this share of the query's best."""
    best = hits.groupBy("qseqid").agg(F.max("bitscore").alias("_best"))
    return hits.join(best, "qseqid").filter(F.col("bitscore") >= F.lit(share) * F.col("_best")).drop("_best")


def accession_taxids(hits: DataFrame, live: DataFrame, dead: DataFrame | None = None, full: bool = False) -> DataFrame:
    """(qseqid, sseqid, raw_taxid): a live entry counts before a dead one, the root without either. Entries match by versioned accession, the four-column files by the bare one too."""
    wanted = hits.select("qseqid", "sseqid").distinct()
    keys = wanted.select("sseqid").distinct()

    def look(table: DataFrame, bare: bool) -> DataFrame:
        ids = table.select(F.col("accession_version").alias("sseqid"), "taxid")
        if bare:
            ids = ids.unionByName(table.select(F.col("accession").alias("sseqid"), "taxid"))
        return ids.join(keys, "sseqid").groupBy("sseqid").agg(F.max("taxid").alias("taxid"))

    out = wanted.join(look(live, not full).withColumnRenamed("taxid", "_live"), "sseqid", "left")
    out = out.join(look(dead, True).withColumnRenamed("taxid", "_dead"), "sseqid", "left") if dead is not None else out.withColumn("_dead", F.lit(None).cast("int"))
    return out.select("qseqid", "sseqid", F.coalesce("_live", "_dead", F.lit(ROOT)).alias("raw_taxid"))


def genome_taxids(hits: DataFrame, genomes: DataFrame) -> DataFrame:
    """(qseqid, sseqid, raw_taxid) by a map of genome accessions, the root where the map has none."""
    wanted = hits.select("qseqid", "sseqid").distinct()
    known = genomes.groupBy(F.col("accession").alias("sseqid")).agg(F.max("taxid").alias("taxid"))
    return wanted.join(known, "sseqid", "left").select("qseqid", "sseqid", F.coalesce("taxid", F.lit(ROOT)).alias("raw_taxid"))


def lca_pair(a: Column, b: Column) -> Column:
    """The lowest common ancestor of two root paths; of a missing path, the root."""
    return F.coalesce(F.element_at(F.array_intersect(a, b), 1), F.lit(ROOT))


def lca_sets(taxa: DataFrame, path: DataFrame) -> DataFrame:
    """(qseqid, lca) of each query's taxids: of one the taxid itself, known or not; the root if one of several is not in the tree.

    A common ancestor is one that all taxids have; of these the deepest counts.
    """
    distinct = taxa.select("qseqid", "taxid").filter("taxid is not null").distinct()
    size = distinct.groupBy("qseqid").agg(F.count("*").alias("_n"), F.min("taxid").alias("_one"))
    above = distinct.join(path, "taxid").select("qseqid", F.size("path").alias("_len"), F.posexplode("path").alias("_i", "ancestor"))
    shared = above.groupBy("qseqid", "ancestor").agg(F.count("*").alias("_k"), F.max(F.col("_len") - F.col("_i")).alias("_depth"))
    deepest = shared.join(size, "qseqid").filter("_k = _n").groupBy("qseqid").agg(F.max_by("ancestor", "_depth").alias("_lca"))
    everyone = taxa.select("qseqid").distinct().join(size, "qseqid", "left").join(deepest, "qseqid", "left")
    return everyone.select("qseqid", F.when(F.col("_n") == 1, F.col("_one")).otherwise(F.coalesce("_lca", F.lit(ROOT))).alias("lca"))


def lca_errors(taxa: DataFrame, path: DataFrame) -> DataFrame:
    """(qseqid, taxids) of queries with several taxids of which one is not in the tree."""
    distinct = taxa.select("qseqid", "taxid").filter("taxid is not null").distinct().join(path.select("taxid", F.lit(True).alias("_in")), "taxid", "left")
    sets = distinct.groupBy("qseqid").agg(F.count("*").alias("_n"), F.count("_in").alias("_k"), F.array_join(F.array_sort(F.collect_list("taxid")).cast("array<string>"), ",").alias("taxids"))
    return sets.filter("_n > 1 and _k < _n").select("qseqid", "taxids")


def blast_to_lca(hits: DataFrame, live: DataFrame, tree: DataFrame, dead: DataFrame | None = None, share: float = 0.9) -> DataFrame:
    """(qseqid, name, rank, lca) of each query."""
    taxa = accession_taxids(top_hits(hits, share), live, dead).select("qseqid", F.col("raw_taxid").alias("taxid"))
    rows = lca_sets(taxa, paths(tree))
    return rows.join(tree.select(F.col("taxid").alias("lca"), "name", "rank"), "lca", "left").select("qseqid", F.coalesce("name", F.lit(UNCLASSIFIED)).alias("name"), F.coalesce("rank", F.lit(UNCLASSIFIED)).alias("rank"), "lca")


def canonical_self(tree: DataFrame, path: DataFrame) -> DataFrame:
    """(taxid, top, top_rank): the nearest ancestor or self of a canonical rank, else the root."""
    rows = lineage_rows(tree, path).groupBy("taxid").agg(F.max_by(F.struct(F.col("ancestor").alias("top"), F.col("rank").alias("top_rank")), "depth").alias("_t"))
    return path.select("taxid").join(rows, "taxid", "left").select("taxid", F.coalesce("_t.top", F.lit(ROOT)).alias("top"), F.coalesce("_t.top_rank", F.lit("root")).alias("top_rank"))


def vote_counts(lcas: DataFrame, tree: DataFrame, path: DataFrame | None = None) -> DataFrame:
    """(contig, rank, taxid, n, first_seen) from the lca of each open reading frame; line_no, if there, sets the order of first sight, else the name."""
    path = paths(tree) if path is None else path
    order = F.col("line_no").cast("string") if "line_no" in lcas.columns else F.col("qseqid")
    order = F.lpad(order, 20, "0") if "line_no" in lcas.columns else order
    rows = lcas.select(orf_contig(F.col("qseqid")).alias("contig"), F.col("lca").alias("taxid"), order.alias("_o"))
    rows = rows.join(canonical_self(tree, path), "taxid")
    return rows.groupBy("contig", F.col("top_rank").alias("rank"), F.col("top").alias("taxid")).agg(F.count("*").alias("n"), F.min("_o").alias("first_seen"))


def _rank_index(rank: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, (*RANKS, "root"))), rank)


def consistency(votes: DataFrame, tree: DataFrame, path: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """votes with consistent and inconsistent: the votes at the same or higher ranks that share a canonical ancestor with the candidate, and the others.

    strict: they are consistent only if one is the other's ancestor or itself.
    """
    sets = lineage_rows(tree, path).groupBy("taxid").agg(F.collect_set("ancestor").alias("canon"))
    v = votes.join(sets, "taxid", "left").withColumn("canon", F.coalesce("canon", F.array().cast("array<int>"))).withColumn("rank_index", _rank_index(F.col("rank")))
    other = v.select("contig", F.col("taxid").alias("o_taxid"), F.col("n").alias("o_n"), F.col("canon").alias("o_canon"), F.col("rank_index").alias("o_index"))
    pairs = v.join(other, "contig").filter("o_index >= rank_index")
    same = F.arrays_overlap("canon", "o_canon") if not strict else F.array_contains("canon", F.col("o_taxid")) | F.array_contains("o_canon", F.col("taxid"))
    same = F.coalesce(same, F.lit(False))
    return pairs.groupBy("contig", "rank", "rank_index", "taxid", "n", "first_seen").agg(F.sum(F.when(same, F.col("o_n")).otherwise(0)).alias("consistent"), F.sum(F.when(same, 0).otherwise(F.col("o_n"))).alias("inconsistent"))


def lowest_majority(votes: DataFrame, tree: DataFrame, path: DataFrame | None = None) -> DataFrame:
    """(contig, taxid): at the most specific rank where one taxon has over half of the contig's different taxids, that taxon; else the root.

    A taxid without an ancestor at a rank at or above its own counts there as unclassified, which never wins.
    """
    path = paths(tree) if path is None else path
    distinct = votes.select("contig", "rank", "taxid").distinct().withColumn("own", _rank_index(F.col("rank")))
    grid = distinct.select("contig", "taxid", "own", F.explode(F.array(*map(F.lit, RANKS))).alias("at")).withColumn("at_index", _rank_index(F.col("at"))).filter("at_index >= own")
    up = lineage_rows(tree, path).select("taxid", "ancestor", F.col("rank").alias("at"))
    rows = grid.join(up, ["taxid", "at"], "left").groupBy("contig", "at_index", F.col("ancestor")).agg(F.count("*").alias("k"))
    total = rows.groupBy("contig", "at_index").agg(F.sum("k").alias("total"))
    won = rows.join(total, ["contig", "at_index"]).filter("ancestor is not null and 2 * k > total").groupBy("contig").agg(F.min_by("ancestor", "at_index").alias("taxid"))
    return votes.select("contig").distinct().join(won, "contig", "left").select("contig", F.coalesce("taxid", F.lit(ROOT)).alias("taxid"))


def majority_vote(votes: DataFrame, tree: DataFrame, path: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """(contig, taxid): from the most specific rank up, by votes, the first candidate with more consistent votes than others; else by lowest_majority."""
    path = paths(tree) if path is None else path
    good = consistency(votes, tree, path, strict).filter("consistent > inconsistent")
    first = good.groupBy("contig").agg(F.min_by("taxid", F.struct("rank_index", -F.col("n"), "first_seen")).alias("_first"))
    return lowest_majority(votes, tree, path).join(first, "contig", "left").select("contig", F.coalesce("_first", "taxid").alias("taxid"))


def share_ancestor(a: Column, b: Column) -> Column:
    """Whether two sets of canonical taxids share one."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def add_ranks(votes: DataFrame, tree: DataFrame) -> DataFrame:
    """votes with the seven rank names; left as they are if they have them."""
    if len(votes.columns) > 2:
        return votes
    filled = votes.join(lineage_frame(tree), "taxid", "left")
    return filled.select("contig", "taxid", *[F.coalesce(r, F.lit(UNCLASSIFIED)).alias(r) for r in reversed(RANKS)])


def kingdom(ranked: DataFrame, name: str) -> DataFrame:
    if "superkingdom" not in ranked.columns:
        raise KeyError("superkingdom")
    return ranked.filter(F.lower("superkingdom") == name.lower())


def filter_taxonomy(df: DataFrame, rank: str, name: str) -> DataFrame:
    """Rows of one taxon; raises if the rank is not a column or no row is left."""
    if rank not in df.columns:
        raise KeyError(rank)
    from ..functions.sequences import taxon_name

    tidy = df.withColumns({r: taxon_name(F.col(r)) for r in RANKS if r in df.columns})
    out = tidy.filter(F.col(rank) == name.lower())
    if out.isEmpty():
        raise ValueError(f"no row has {name} as its {rank}")
    return out


def assign(spark, start: str, **tables: DataFrame) -> DataFrame:
    """(contig, taxid) from the furthest table there is: votes as they are, lca tables by vote, hits by lca and vote."""
    if start == "votes":
        return tables["votes"]
    tree = tables["tree"]
    lcas = tables["lca"] if start == "lca" else blast_to_lca(tables["hits"], tables["live"], tree, tables.get("dead"))
    if start not in ("lca", "hits"):
        raise ValueError(f"cannot start from {start}")
    path = paths(tree)
    return majority_vote(vote_counts(lcas, tree, path), tree, path)


ANCESTRY = T.ArrayType(T.IntegerType())
