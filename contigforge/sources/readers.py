"""Readers of sequence, taxonomy, alignment, graph and log files; every reader gives a DataFrame of a fixed schema and reads through Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig, description, sequence) of plain or gzip FASTA files. A record begins with > at the start of a line, so a > in a description does no harm."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("r")).filter(F.trim("r") != "")
    head = F.regexp_replace(F.substring_index("r", "\n", 1), "\r$", "")
    body = F.when(F.instr("r", "\n") > 0, F.expr("substr(r, instr(r, '\n') + 1)")).otherwise("")
    return records.select(F.substring_index(head, " ", 1).alias("contig"), head.alias("description"), F.regexp_replace(body, "\\s", "").alias("sequence"))


def fasta_folder(spark: SparkSession, path: str) -> DataFrame:
    """(bin, contig) of a folder with a FASTA file, or a folder cluster=name of files, for each bin; a file's bin is its name without the last suffix."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.input_file_name().alias("f"), "value").filter(F.col("value").startswith(">"))
    folder = F.url_decode(F.regexp_extract("f", "/cluster=([^/]+)/[^/]*$", 1))
    name = F.regexp_replace(F.substring_index("f", "/", -1), r"\.[^.]*$", "")
    return lines.select(F.when(folder != "", folder).otherwise(name).alias("bin"), F.substring_index(F.regexp_replace("value", "^>", ""), " ", 1).alias("contig"))


def combined_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(accession, description, sequence) of genome files, each record named by the assembly accession of its path and its own name."""
    return _combined(spark.read.option("lineSep", "\n>").text(path).select(F.input_file_name().alias("path"), F.col("value").alias("r")))


def combined_archive(spark: SparkSession, path: str) -> DataFrame:
    """combined_fasta of genome files that lie in an archive of writers.fasta_archive: for genomes by the hundred thousand, too many for a file each."""
    return _combined(spark.read.parquet(path).select("path", F.explode(F.split("content", "\n>")).alias("r")))


def _combined(records: DataFrame) -> DataFrame:
    """records: the path of the file, and a record of it."""
    from ..functions.sequences import genome_accession

    records = records.select(genome_accession(F.col("path")).alias("accession"), F.regexp_replace("r", "^>", "").alias("r")).filter(F.trim("r") != "")
    return records.select("accession", F.concat("accession", F.lit(" "), F.substring_index("r", "\n", 1)).alias("description"), F.regexp_replace(F.expr("substr(r, length(substring_index(r, '\n', 1)) + 1)"), "\\s", "").alias("sequence"))


def tsv(spark: SparkSession, path: str, schema: str, header: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Tab-separated files, an empty field null; columns prunes."""
    rows = spark.read.schema(schema).csv(path, sep="\t", header=header)
    return rows.select(*columns) if columns else rows


def dump(spark: SparkSession, path: str) -> DataFrame:
    """Fields of a taxonomy dump, between tab, bar and tab."""
    line = F.regexp_replace("value", r"\t\|$", "")
    return spark.read.text(path).filter(F.trim("value") != "").select(F.split(line, r"\t\|\t").alias("f"))


def names_dump(spark: SparkSession, path: str) -> DataFrame:
    """(taxid, name): scientific names in lower case."""
    return dump(spark, path).filter(F.trim(F.get("f", F.lit(3))) == "scientific name").select(F.trim(F.get("f", F.lit(0))).cast("int").alias("taxid"), F.lower(F.trim(F.get("f", F.lit(1)))).alias("name"))


def nodes_dump(spark: SparkSession, path: str) -> DataFrame:
    """(taxid, parent, rank); the root is its own parent and has the rank root."""
    rows = dump(spark, path).select(*[F.trim(F.get("f", F.lit(i))).alias(c) for i, c in enumerate(("taxid", "parent", "rank"))])
    rows = rows.select(F.col("taxid").cast("int").alias("taxid"), F.col("parent").cast("int").alias("parent"), F.lower("rank").alias("rank")).filter(F.col("taxid") != schemas.ROOT)
    root = spark.range(1).select(F.lit(schemas.ROOT).alias("taxid"), F.lit(schemas.ROOT).alias("parent"), F.lit("root").alias("rank"))
    return rows.unionByName(root)


def merged_dump(spark: SparkSession, path: str) -> DataFrame:
    return dump(spark, path).select(F.trim(F.get("f", F.lit(0))).cast("int").alias("old_taxid"), F.trim(F.get("f", F.lit(1))).cast("int").alias("new_taxid"))


def deleted_dump(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_extract("value", r"(\d+)", 1).try_cast("int").alias("taxid")).filter("taxid is not null")


def accession_taxids(spark: SparkSession, path: str, full: bool = False) -> DataFrame:
    return tsv(spark, path, schemas.ACCESSION_FULL if full else schemas.ACCESSION4)


def blast6(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, schemas.BLAST6, header=False)


# The first 18 columns of the per-domain hits table of profile searches; the rest of a line is the description.
TBLOUT = ("target", "target_accession", "query", "query_accession", "evalue", "score", "bias", "domain_evalue", "domain_score", "domain_bias", "exp", "reg", "clu", "ov", "env", "dom", "rep", "inc")


def tblout(spark: SparkSession, path: str) -> DataFrame:
    """(orf, sacc, sname, evalue, score) of a profile search against open reading frames: fields between white space, # lines left out. The target is the profile."""
    f = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split(F.trim("value"), r"\s+").alias("f"))
    at = lambda name: F.get("f", F.lit(TBLOUT.index(name)))
    return f.select(at("query").alias("orf"), at("target_accession").alias("sacc"), at("target").alias("sname"), at("evalue").try_cast("double").alias("evalue"), at("score").try_cast("double").alias("score"))


def bed_coverage(spark: SparkSession, path: str) -> DataFrame:
    """(contig, coverage): depth times bases over the length, of a histogram of depths; the whole genome's rows are left out."""
    rows = tsv(spark, path, schemas.BED_HISTOGRAM, header=False).filter("contig <> 'genome'")
    return rows.groupBy("contig").agg((F.sum(F.col("depth") * F.col("bases")) / F.max("length")).alias("coverage"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).filter(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("f"))
    fields = [x.split() for x in schemas.SAM.split(", ")]
    return lines.select(*[F.get("f", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def sseqid_taxids(spark: SparkSession, path: str) -> DataFrame:
    """(qseqid, taxids) from the first and last columns of a table with a header."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f")).filter(F.get("f", F.lit(0)) != "qseqid")
    return rows.select(F.get("f", F.lit(0)).alias("qseqid"), F.element_at("f", -1).try_cast("int").alias("taxid")).groupBy("qseqid").agg(F.array_sort(F.collect_set("taxid")).alias("taxids"))


SAMPLESHEET = "sample string, assembly string, fastq_1 string, fastq_2 string, coverage_tab string, cov_from_assembly string"


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """A checked sample sheet: raises on a missing sample or assembly, a sample twice, spaces in names, or no source of coverage."""
    rows = spark.read.schema(SAMPLESHEET).csv(path, header=True)
    checks = {
        "a row lacks its sample or assembly": rows.filter("sample is null or assembly is null"),
        "a sample's name has a space": rows.filter(F.col("sample").contains(" ")),
        "a sample comes twice": rows.groupBy("sample").count().filter("count > 1"),
        "a row has neither reads, a coverage table nor coverage from the assembly": rows.filter("fastq_1 is null and coverage_tab is null and coalesce(cov_from_assembly, '0') = '0'"),
        "cov_from_assembly is neither 0 nor spades": rows.filter("coalesce(cov_from_assembly, '0') not in ('0', 'spades')"),
    }
    for says, bad in checks.items():
        if (row := bad.first()) is not None:
            raise ValueError(f"{says}: {row.asDict()}")
    return rows


def gfa(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables segments (segment, length), links (from, orient, to, orient) and paths (path, segment, orient, position)."""
    f = spark.read.text(path).select(F.split("value", "\t").alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    segments = f.filter(at(0) == "S").select(at(1).alias("segment"), F.length(at(2)).alias("length"))
    links = f.filter(at(0) == "L").select(at(1).alias("from_segment"), at(2).alias("from_orient"), at(3).alias("to_segment"), at(4).alias("to_orient"))
    paths = f.filter(at(0) == "P").select(at(1).alias("path"), F.posexplode(F.split(at(2), "[,;]")).alias("position", "step")).filter("step <> ''")
    return {"segments": segments, "links": links, "paths": paths.select("path", F.expr("substr(step, 1, length(step) - 1)").alias("segment"), F.expr("right(step, 1)").alias("orient"), "position")}


def scaffold_paths(spark: SparkSession, path: str) -> DataFrame:
    """(scaffold, position, segment, orient) of a scaffold path file: a name, then its steps, those of gaps between semicolons; a name that ends in ' is the other strand and is left out."""
    records = spark.read.option("lineSep", "\nNODE_").text(path).select(F.when(F.col("value").startswith("NODE_"), F.col("value")).otherwise(F.concat(F.lit("NODE_"), "value")).alias("r"))
    name = F.trim(F.substring_index("r", "\n", 1))
    body = F.expr("substr(r, length(substring_index(r, '\n', 1)) + 1)")
    steps = records.filter(~name.endswith("'")).select(name.alias("scaffold"), F.posexplode(F.filter(F.split(F.regexp_replace(body, "\\s", ""), "[,;]"), lambda x: x != "")).alias("position", "step"))
    return steps.select("scaffold", "position", F.expr("substr(step, 1, length(step) - 1)").alias("segment"), F.expr("right(step, 1)").alias("orient"))


def nucmer_coords(spark: SparkSession, path: str) -> DataFrame:
    """(reference, contig, start, end, identity) of a coords table with bars between its groups; the two lines above the rows are left out."""
    f = spark.read.text(path).filter(F.col("value").rlike(r"^\s*\d+\s+\d+\s*\|")).select(F.split(F.trim("value"), r"\s*\|\s*").alias("g"))
    own = lambda i: F.split(F.get("g", F.lit(i)), r"\s+")
    return f.select(F.get(own(4), F.lit(0)).alias("reference"), F.get(own(4), F.lit(1)).alias("contig"), F.get(own(0), F.lit(0)).cast("long").alias("start"), F.get(own(0), F.lit(1)).cast("long").alias("end"), F.get(own(3), F.lit(0)).cast("double").alias("identity"))


def assembly_alignments(spark: SparkSession, path: str) -> DataFrame:
    """(contig, reference, identity, best) of an alignment report: rows of S1, E1, S2, E2, reference, contig, identity, ambiguous, best group; other lines are marks of a block."""
    f = spark.read.text(path).select(F.split("value", "\t").alias("f")).filter((F.size("f") >= 7) & F.get("f", F.lit(0)).try_cast("long").isNotNull())
    at = lambda i: F.get("f", F.lit(i))
    return f.select(at(5).alias("contig"), at(4).alias("reference"), at(6).cast("double").alias("identity"), (F.coalesce(at(8), F.lit("")) != "").alias("best"))


def best_alignments(rows: DataFrame) -> DataFrame:
    """(contig, reference): of each contig the alignment of greatest identity, as a number; of equals the first reference by name."""
    return rows.groupBy("contig").agg(F.min_by("reference", F.struct((-F.col("identity")).alias("i"), "reference")).alias("reference"))


def binning_log(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no?, at, rank, taxon, what, seconds): the steps of a run from its log lines "[month/day/year time AM] LEVEL ...: message", each lasting until the next line of its file.

    A line that names a rank and a taxon holds for the lines after it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), F.regexp_extract("value", r"\[(\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2} [AP]M)", 1).alias("t"), F.regexp_extract("value", r"\]\s*(?:[\w.]+:)?\s*(.*)$", 1).alias("what"), F.regexp_extract("value", r"(?i)examining (?:taxonomy:? )?(\w+)\s*[:=]", 1).alias("r"), F.regexp_extract("value", r"(?i)examining taxonomy:? \w+\s*[:=]\s*([^:]+?)\s*(?::|$)", 1).alias("x")).filter("t <> ''")
    rows = lines.withColumn("at", F.to_timestamp("t", "MM/dd/yyyy hh:mm:ss a"))
    w = Window.partitionBy("file").orderBy("block", "line")  # as they stand in the file
    rows = rows.withColumn("rank", F.last(F.when(F.col("r") != "", F.col("r")), True).over(w)).withColumn("taxon", F.last(F.when(F.col("x") != "", F.col("x")), True).over(w))
    return rows.select("file", "at", "rank", "taxon", "what", (F.unix_timestamp(F.lead("at").over(w)) - F.unix_timestamp("at")).alias("seconds"))
