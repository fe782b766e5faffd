"""Line deduplication by the spread of sites: HyperLogLog sketches of the sites of each line hash merge by aggregation.

Lines whose estimate is clearly above or below the threshold are decided by it; those near it get an exact distinct count. A line on
enough sites is boilerplate and is removed wherever it stands, but for the document of least id that has it (keep_first).

DataFrame functions only. Contract:
- a line is what stands between line feeds, trimmed of spaces, tabs and carriage returns for comparison; blank lines are never removed;
- a null or empty text has one blank line and stays as it is (null stays null); a null site counts as a site of its own;
- a null id stays null and is never the one kept, unless all ids of the line are null: then every occurrence goes;
- repeated rows are kept as rows and lose the same lines; an empty table gives an empty one; extra columns come back unchanged in remove_lines().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, documents, fresh, stage

#: Distinct sites that make a line boilerplate.
MIN_SITES = 5
#: Bits of a sketch's register index: 2 ** 11 registers, a standard error of about 2.3 %.
LG_K = 11
#: Standard errors about the threshold inside which the exact count decides.
NEAR = 4


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits of the trimmed line; null for a blank one."""
    bare = F.trim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit("line"), bare).alias("b")))


def boilerplate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(key, sites, first_id) of the lines on min_sites sites or more. sites is exact for lines near the threshold, else the estimate."""
    rows = df.select(column(id_col).cast("long").alias("id"), F.coalesce(F.concat(F.lit("s"), column(site_col).cast("string")), F.lit("")).alias("site"), F.explode(F.array_distinct(F.transform(_lines(column(text_col).cast("string")), _key))).alias("key")).filter("key is not null")
    pairs = rows.groupBy("key", "site").agg(F.min("id").alias("id"))  # a row for each line and site: partial aggregation folds hot lines before they move
    spread = pairs.groupBy("key").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"), F.min("id").alias("first_id"))
    width = max(1.0, NEAR * 1.04 / 2 ** (lg_k / 2) * min_sites)
    seen = spread.select("key", "first_id", F.hll_sketch_estimate("sketch").alias("estimate")).filter(F.col("estimate") >= min_sites - width)
    near = seen.filter(F.abs(F.col("estimate") - min_sites) <= width)
    exact = pairs.join(near.select("key"), "key", "left_semi").groupBy("key").agg(F.count_distinct("site").alias("exact"))
    counted = seen.join(exact, "key", "left").select("key", "first_id", F.coalesce("exact", "estimate").alias("sites"))
    return counted.filter(F.col("sites") >= min_sites)


def _marked(df: DataFrame, ids: Column, text: Column, found: DataFrame, keep_first: bool, names: list[str]) -> DataFrame:
    """The id, the text's hash and the places of lines to remove, of each document that has any, under these names; places count from 0."""
    rows = df.select(ids.alias("id"), F.xxhash64(text).alias("hash"), F.posexplode(F.transform(_lines(text), _key)).alias("place", "key")).filter("key is not null")
    hit = rows.join(found.select("key", "first_id"), "key")
    if keep_first:
        hit = hit.filter(~F.col("id").eqNullSafe(F.col("first_id")) | F.col("id").isNull())
    return hit.groupBy(F.col("id").alias(names[0]), F.col("hash").alias(names[1])).agg(F.collect_set("place").alias(names[2]))


def remove_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, keep_first: bool = True) -> DataFrame:
    """df with boilerplate lines cut from its texts; all columns as they were, with line counts _n_lines and _n_removed added, under names with more underscores before them where df has such columns."""
    ids, text = column(id_col).cast("long"), column(text_col).cast("string")
    own_id, own_hash, places, n_lines, n_removed = (fresh(df, n) for n in ("m_id", "m_hash", "places", "_n_lines", "_n_removed"))
    found = stage(boilerplate(df, id_col, text_col, site_col, min_sites), "boilerplate")  # a table of known size: the join is by broadcast where that is small, else it can split hot lines
    marks = _marked(df, ids, text, found, keep_first, [own_id, own_hash, places])
    rows = df.join(marks, ids.eqNullSafe(F.col(own_id)) & (F.xxhash64(text) == F.col(own_hash)), "left")
    kept = F.array_join(F.filter(_lines(text), lambda _, i: ~F.array_contains(F.col(places), i)), "\n")
    return rows.select(
        *[F.when(F.col(places).isNull(), column(c)).otherwise(kept).alias(c) if c == text_col else column(c) for c in df.columns],
        F.coalesce(F.size(_lines(text)), F.lit(1)).cast("long").alias(n_lines),
        F.coalesce(F.size(places), F.lit(0)).cast("long").alias(n_removed),
    )


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts of every document and a digest of the text it keeps."""
    kept = remove_lines(documents(spark, sf_dir))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.char_length(text).cast("long").alias("kept_chars"), F.md5(text.cast("binary")).alias("kept_md5"))


OP10_SQL = f"""
WITH lines AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents),
trimmed AS (SELECT doc_id, site, line, place, trim(line, chr(32) || chr(9) || chr(13)) AS bare FROM lines),
found AS (
  SELECT bare, min(doc_id) AS first_id FROM trimmed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= {MIN_SITES}),
marked AS (
  SELECT t.doc_id, t.place, t.line, f.bare IS NOT NULL AND t.doc_id <> f.first_id AS gone
  FROM trimmed t LEFT JOIN found f ON t.bare = f.bare)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       length(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))::BIGINT AS kept_chars,
       md5(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_md5
FROM marked GROUP BY doc_id
"""
