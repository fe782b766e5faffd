"""Document fingerprints: threshold-scaled sketches keep every shingle hash below a fixed fraction of the hash range.

As the threshold is the same for all documents, the sketch of a union is the union of sketches, and containment can be estimated
between documents of very unequal length.

DataFrame functions only. Contract:
- words stand between spaces, tabs and line ends; a text of fewer than SHINGLE words has one shingle, of its words;
- a null text counts as empty; a null id sorts below all ids and stays null;
- repeated rows are kept each, rows of one id in the order of their texts' hashes; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpoint, documents, texts

#: Words in a shingle.
SHINGLE = 5
#: A shingle hash is kept if its highest KEEP_BITS bits are 0: one in four.
KEEP_BITS = 2
#: Bits stored of a kept hash.
STORED_BITS = 40
#: Documents that are dealt together when neighbours are looked up, on average, and groups of them at most; beyond, groups grow.
NEIGHBOURS = 256
GROUPS = 1 << 16


def _let(value: Column, body) -> Column:
    """body(value) with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def sketch(text: Column, shingle: int = SHINGLE, keep_bits: int = KEEP_BITS) -> Column:
    """The sorted distinct hashes that a text keeps: array<bigint>."""
    words = F.filter(F.split(text, "[ \\t\\n\\r\\x0B\\f]+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        shingles = F.transform(F.sequence(F.lit(0), F.size(w) - shingle), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
        whole = F.transform(F.filter(F.array(F.array_join(w, " ")), lambda x: x != ""), lambda x: F.xxhash64(x))
        return F.when(F.size(w) >= shingle, shingles).otherwise(whole)

    kept = F.filter(_let(words, hashes), lambda h: F.shiftrightunsigned(h, 64 - keep_bits) == 0)
    return F.array_sort(F.array_distinct(F.transform(kept, lambda h: F.shiftrightunsigned(h, 64 - keep_bits - STORED_BITS))))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Share of a's shingles that b has too; null if a keeps none."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))


def likeness(a: Column, b: Column, a_hash: Column, b_hash: Column) -> Column:
    """Shared shingles over all shingles, 0 to 1. Texts of equal hash are alike; if neither of two others keeps a shingle, nothing is known to be shared."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(a_hash == b_hash, 1.0).when(every == 0, 0.0).otherwise(both / every).cast("double")


def as_string(text_hash: Column, kept: Column) -> Column:
    """16 hexadecimal digits of the whole text's hash, then STORED_BITS / 4 for each kept hash."""
    digits = STORED_BITS // 4
    return F.lower(F.concat(F.lpad(F.hex(text_hash), 16, "0"), F.array_join(F.transform(kept, lambda h: F.lpad(F.hex(h), digits, "0")), "")))


def _literal(values: list, kind: str) -> Column:
    """An array of many numbers as one expression."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _grouped(rows: DataFrame) -> DataFrame:
    """rows with grp, which ascends with (k, text_hash): cuts at quantiles of k, and inside an id that takes several of them at even distances of the hash."""
    groups = min(GROUPS, rows.count() // NEIGHBOURS)
    if groups < 2:
        return rows.withColumn("grp", F.lit(0).cast("long"))
    shares = _literal([i / groups for i in range(1, groups)], "double")
    cuts = rows.agg(F.percentile_approx("k", shares, max(10_000, 10 * groups))).first()[0]
    times = Counter(cuts)
    low = sorted(times)
    names, many = _literal(low, "bigint"), _literal([times[c] for c in low], "int")

    def step(at: Column, _: Column) -> Column:
        """Halves the range in which the number of cuts up to k lies."""
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        up = F.get(names, middle) <= F.col("k")
        return F.when(at["lo"] >= at["hi"], at).otherwise(F.struct(F.when(up, middle + 1).otherwise(at["lo"]).alias("lo"), F.when(up, at["hi"]).otherwise(middle).alias("hi")))

    found = F.aggregate(F.sequence(F.lit(0), F.lit(len(low).bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(len(low)).alias("hi")), step, lambda x: x["lo"])

    def place(at: Column) -> Column:
        mine = (at > 0) & (F.get(names, at - 1) == F.col("k"))
        part = F.floor((F.shiftright("text_hash", 32) + (1 << 31)) * F.get(many, at - 1) / (1 << 32))
        return at.cast("long") * (groups + 1) + F.when(mine, part).otherwise(groups)

    return rows.withColumn("grp", _let(found, place))


def _followers(groups: DataFrame) -> DataFrame:
    """(grp, follower): the next group in ascending order, and the first after the last; of at most 2 * GROUPS rows."""
    order = Window.orderBy("grp")
    return groups.select("grp", F.coalesce(F.lead("grp").over(order), F.first("grp").over(order)).alias("follower"))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, text_hash, grp, guest, k): all documents by groups of near ids, each group opened by a guest, the document that follows its least id in descending order.

    So the next document in descending order is the row before it within the group. Texts move once, whatever the ids; of guests there is one for a group.
    """
    rows = _grouped(texts(df, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.coalesce("doc_id", F.lit(-(2**63))).alias("k")))
    lasts = checkpoint(rows.groupBy("grp").agg(F.max(F.struct("k", "text_hash")).alias("last")).select("grp", "last.*"))
    ends = rows.join(F.broadcast(lasts), ["grp", "k", "text_hash"], "left_semi").dropDuplicates(["grp"])  # at most 2 * GROUPS rows of 24 bytes
    guests = ends.join(F.broadcast(_followers(lasts.select("grp"))), "grp").select("doc_id", "text", "text_hash", "k", F.col("follower").alias("grp"), F.lit(1).alias("guest"))
    return rows.withColumn("guest", F.lit(0)).unionByName(guests)


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the start of the next document, their likenesses, and how much of the text's fingerprint the other has."""
    w = Window.partitionBy("grp").orderBy(F.col("guest").desc(), "k", "text_hash")
    rows = with_next(df, id_col, text_col).withColumn("next_text", F.coalesce(F.lag("text").over(w), F.lit("")))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.when(F.col("guest") == 0, F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))))
    rows = rows.select("doc_id", "grp", "guest", "k", "text_hash", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("edited").alias("edited_hash"), sketch(F.col("text")).alias("own"), F.when(F.col("guest") == 0, sketch(F.col("edited"))).alias("other"))
    rows = rows.withColumn("next_own", F.lag("own").over(w)).withColumn("next_hash", F.lag("text_hash").over(w)).filter("guest = 0")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        as_string(F.col("text_hash"), F.col("own")).alias("fingerprint"), as_string(F.col("edited_hash"), F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), F.col("text_hash"), F.col("edited_hash")).alias("near_edited"), likeness(F.col("own"), F.col("next_own"), F.col("text_hash"), F.col("next_hash")).alias("near_next"),
        containment(F.col("own"), F.col("other")).alias("in_edited"), containment(F.col("own"), F.col("next_own")).alias("in_next"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and the likeness to its neighbour."""
    return compare_edited(documents(spark, sf_dir))
