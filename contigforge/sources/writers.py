"""Writers: tables, FASTA by group, and reports of fixed format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tsv(df: DataFrame, path: str, compressed: bool = False, places: int | None = None) -> None:
    """Tab-separated with a header; places fixes the digits of doubles."""
    if places is not None:
        df = df.select(*[F.format_string(f"%.{places}f", c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    df.write.csv(path, sep="\t", header=True, compression="gzip" if compressed else "none", mode="error", nullValue="")


def record(name: Column, sequence: Column, width: int = 60) -> Column:
    """A FASTA record with lines of a width."""
    return F.concat(F.lit(">"), name, F.lit("\n"), F.regexp_replace(F.regexp_replace(sequence, f"(.{{{width}}})", "$1\n"), "\n$", ""))


def fasta(contigs: DataFrame, path: str) -> None:
    contigs.select(record(F.coalesce("description", "contig") if "description" in contigs.columns else F.col("contig"), F.col("sequence")).alias("value")).write.mode("error").text(path)


def fasta_by(contigs: DataFrame, by: str, path: str) -> None:
    """A folder for each value of a column; the path must not exist."""
    contigs.select(by, record(F.col("contig"), F.col("sequence")).alias("value")).write.mode("error").partitionBy(by).text(path)


def fasta_archive(contigs: DataFrame, by: str, path: str) -> None:
    """FASTA files of fasta_by as one table (path, content), a row for each record, so that no store has to hold a folder and a file for each value."""
    name = F.concat(F.lit(f"{by}="), F.col(by).cast("string"), F.lit(".fasta"))
    contigs.select(name.alias("path"), F.concat(record(F.col("contig"), F.col("sequence")), F.lit("\n")).alias("content")).write.mode("error").parquet(path)


def cluster_fasta(contigs: DataFrame, bins: DataFrame, path: str) -> None:
    """A folder for each cluster, unclustered for the rest."""
    rows = contigs.join(bins.select("contig", F.coalesce("cluster", F.lit("unclustered")).alias("cluster")), "contig")
    fasta_by(rows, "cluster", path)


def rank_groups(contigs: DataFrame, ranked: DataFrame, rank: str) -> DataFrame:
    """contigs with their name at a rank; those without taxonomy join unclassified if that group exists, else they are left out."""
    names = ranked.select("contig", F.col(rank).alias("_n"))
    rows = contigs.join(names, "contig", "left")
    if names.filter("_n = 'unclassified'").isEmpty():
        rows = rows.filter("_n is not null")
    return rows.withColumn("_n", F.coalesce("_n", F.lit("unclassified"))).withColumnRenamed("_n", rank)


def rank_fasta(contigs: DataFrame, ranked: DataFrame, rank: str, path: str) -> None:
    fasta_by(rank_groups(contigs, ranked, rank), rank, path)


def biobox_lines(df: DataFrame, kind: str, sample: str, version: str = "0.9.0") -> DataFrame:
    """(line_no, value) of a binning report: genome_binning from contig and cluster, taxon_binning from contig and taxid."""
    if kind == "profiling":
        raise NotImplementedError("profiles are not written")
    columns = {"genome_binning": ("contig", "cluster", "BINID"), "taxon_binning": ("contig", "taxid", "TAXID")}
    if kind not in columns:
        raise ValueError(f"unknown kind {kind}")
    key, value, title = columns[kind]
    head = ["@Version:" + version, "@SampleID:" + sample, "", f"@@SEQUENCEID\t{title}"]
    top = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(head)], "line_no long, value string")
    rows = df.filter(F.col(value).isNotNull()).select(F.lit(len(head)).cast("long").alias("line_no"), F.concat_ws("\t", F.col(key), F.col(value).cast("string")).alias("value"))
    return top.unionByName(rows)


def biobox(df: DataFrame, path: str, kind: str, sample: str) -> None:
    """One text file, its header first."""
    biobox_lines(df, kind, sample).orderBy("line_no", "value").coalesce(1).select("value").write.mode("error").text(path)


def merged_tsv(spark, paths: list[str], schema: str) -> DataFrame:
    """The rows of several tables of one header."""
    return spark.read.schema(schema).csv(paths, sep="\t", header=True)
