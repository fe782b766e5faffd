"""Scalar functions of sequences and names, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def canonical(kmer: Column) -> Column:
    """The strand that comes first in the order A, T, C, G."""
    back = reverse_complement(kmer)
    return F.when(F.translate(kmer, "ATCG", "0123") <= F.translate(back, "ATCG", "0123"), kmer).otherwise(back)


def gc_percent(seq: Column) -> Column:
    """100 (G + C + S) / (A + C + G + T + U + S + W), letters of any case; 0 without countable letters."""
    gc = F.length(F.regexp_replace(seq, "[^GCSgcs]", ""))
    of = F.length(F.regexp_replace(seq, "[^ACGTUSWacgtusw]", ""))
    return F.coalesce(gc * F.lit(100.0) / F.nullif(of, F.lit(0)), F.lit(0.0))


def header_coverage(contig: Column) -> Column:
    """The number after the last _cov_ of an assembler's contig name; null if there is none."""
    return F.when(contig.contains("_cov_"), F.element_at(F.split(contig, "_cov_"), -1).try_cast("double"))


def orf_contig(orf: Column) -> Column:
    """The contig of an open reading frame: its name without the last _number."""
    return F.regexp_replace(orf, "_[^_]*$", "")


def taxon_name(name: Column) -> Column:
    """Lower case, with space, slash and parentheses as underscores."""
    return F.translate(F.lower(name), " /()", "____")


def zero_padded(prefix: str, number: Column, width: int) -> Column:
    """prefix and the number with zeros in front; a longer number is never cut."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def genome_accession(path: Column) -> Column:
    return F.regexp_extract(path, r"(GC[AF]_\d+\.\d?)", 1)
