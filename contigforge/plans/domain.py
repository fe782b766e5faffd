"""Domain tables derived from the driver's tables, the same way in Spark and in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"

#: name: (Spark SQL, DuckDB SQL or None where it is the same). Later tables use earlier ones.
TABLES: dict[str, tuple[str, str | None]] = {
    "contigs": (
        f"SELECT concat('NODE_', doc_id, '_length_', length(sequence), '_cov_', doc_id % 50 + 1, '.5') AS contig, sequence, doc_id FROM (SELECT doc_id, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', ''), '{LETTERS}', '{BASES}') AS sequence FROM documents)",
        f"SELECT concat('NODE_', doc_id, '_length_', length(sequence), '_cov_', doc_id % 50 + 1, '.5') AS contig, sequence, doc_id FROM (SELECT doc_id, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}') AS sequence FROM documents)",
    ),
    "markers": ("SELECT concat('c', l_suppkey) AS contig, concat('PF', l_partkey) AS sacc, l_quantity AS score FROM lineitem", None),
    "cutoffs": ("SELECT concat('PF', p_partkey, '.', p_size) AS accession, cast(p_size AS double) AS cutoff FROM part", None),
    "bins": (
        "SELECT concat('c', s_suppkey) AS contig, CASE WHEN s_suppkey % 7 <> 0 THEN concat('bin_', lpad(cast(s_nationkey AS string), 4, '0')) END AS cluster, cast(3000 + (s_suppkey * 7919) % 50000 AS bigint) AS length, 30 + cast((s_suppkey * 31) % 4000 AS double) / 100 AS gc_content, 1 + cast((s_suppkey * 17) % 1000 AS double) / 10 AS coverage, cast(100000 + s_suppkey AS int) AS taxid, s_suppkey AS contig_order FROM supplier",
        None,
    ),
    "tree": (
        "SELECT 1 AS taxid, 1 AS parent, 'root' AS rank, 'root' AS name UNION ALL SELECT 10 + r_regionkey, 1, 'superkingdom', lower(r_name) FROM region UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, CASE WHEN n_nationkey % 5 = 0 THEN 'clade' ELSE 'phylum' END, lower(n_name) FROM nation UNION ALL SELECT cast(100000 + s_suppkey AS int), 100 + s_nationkey, 'species', lower(s_name) FROM supplier",
        None,
    ),
    "hits": ("SELECT concat('k', o_custkey, '_', l_orderkey) AS qseqid, concat('A', l_suppkey, '.1') AS sseqid, l_extendedprice AS bitscore FROM lineitem JOIN orders ON l_orderkey = o_orderkey", None),
    "live": ("SELECT concat('A', s_suppkey) AS accession, concat('A', s_suppkey, '.1') AS accession_version, cast(100000 + s_suppkey AS int) AS taxid FROM supplier", None),
    "truth": ("SELECT concat('c', s_suppkey) AS contig, CASE WHEN s_suppkey % 11 = 0 THEN 'misassembled' ELSE concat('g', (s_suppkey * 13) % 20) END AS reference_genome, cast(3000 + (s_suppkey * 7919) % 50000 AS bigint) AS length, cast(100000 + (s_suppkey * 3) % 90 + 1 AS int) AS taxid FROM supplier", None),
    "edges": ("SELECT concat('s', l_suppkey) AS u, concat('p', l_partkey) AS v FROM lineitem", None),
}
BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels")


def duck(query: str, *extra: str) -> str:
    """query with the domain tables that it names, and further CTEs, before it."""
    import re

    parts: list[str] = []
    wanted = query + " ".join(extra)
    for name, (spark, own) in TABLES.items():
        if re.search(rf"\b{name}\b", wanted):
            parts.append(f"{name} AS ({(own or spark).replace('AS string)', 'AS varchar)').replace('AS int)', 'AS integer)')})")
    parts += extra
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + query


class Domain:
    """The domain tables of one folder, as DataFrames by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            query = TABLES[name][0]
            used = [t for t in BASE_TABLES if f" {t}" in query]
            return self.spark.sql(_named(query, used), **{t: self.base(t) for t in used})
        if name in BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)


def _named(query: str, used: list[str]) -> str:
    import re

    for t in used:
        query = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", query)
    return query
