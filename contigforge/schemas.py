"""Fixed schemas of the tables that the engine reads and writes."""

# Ranks from the most to the least specific, and the root.
RANKS = ("species", "genus", "family", "order", "class", "phylum", "superkingdom")
ROOT = 1
UNCLASSIFIED = "unclassified"

BLAST6 = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
CUTOFFS = "accession string, cutoff double"
COVERAGE = "contig string, coverage double"
BED_HISTOGRAM = "contig string, depth long, bases long, length long, depth_fraction double"
LCA = "qseqid string, name string, rank string, lca int"
VOTES = "contig string, taxid int"
ACCESSION4 = "accession string, accession_version string, taxid int, gi string"
ACCESSION_FULL = "accession_version string, taxid int"
GTDB_MAP = "accession string, taxid int"
SAM = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"
