"""SimHash near-duplicates: 64-bit fingerprints linked at BITS or fewer differing bits, found by a pigeonring filter.

The fingerprint is a ring of eight segments of a byte. Two fingerprints that differ in at most t bits have a segment from which every
chain of l consecutive segments differs in at most l * t / 8 bits. For t = 3 such a chain begins with two equal segments, then at most one
bit more in three segments, and so on. So fingerprints are dealt by a segment and the next, 16 bits and one of eight places of the ring;
within such a bucket, chains are compared by their running differences, and only what keeps to the budgets gets the full Hamming check.
A bucket holds about 1/65536 of the distinct fingerprints, 8 bytes each; one that is larger than SMALL is divided again by the
segments that follow, as the chain condition holds from another start inside it or not at all. From a bucket come edges that
keep its linked fingerprints connected, fewer than it has members, never all pairs.

Contract of groups():
- words are runs of other bytes than space and \\t to \\r, A-Z in lower case; a text of fewer than SHINGLE words has one shingle, its words; without
  words (or null) the fingerprint is zero, which links like any other;
- a null id counts as larger than all ids and gets the component of its fingerprint's others, or null;
- repeated rows are kept each; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, checkpoint, documents, make_room, map_batches, shuffle_partitions, stage, texts, worker_state
from .components import components, renamed

SHINGLE = 3
BITS = 3
SEED = 42
SEGMENTS = 8
#: Members of a bucket that are compared without dividing it again.
SMALL = 64


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; repeats count."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    row = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[shingle - 1 :].tolist() if len(words) >= shingle else [len(row)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(row[s:e], seed) for s, e in zip(starts, stops, strict=True)], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""

    def make():
        worker_state("simhash", object)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            return batch(doc_id=(b.column("doc_id"), None), fp=(pa.array(fp.view(np.int64)), None))

        return one

    return map_batches(texts(df, id_col, text_col), make, "doc_id long, fp long")


_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _chain(a: np.ndarray, b: np.ndarray, start: int, bits: int) -> np.ndarray:
    """Which pairs keep the budget of every chain from this segment on, and differ in at most bits in all: the last chain is the whole ring."""
    x = (a ^ b).view(np.uint8).reshape(-1, 8)
    spent, alive = np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for k in range(SEGMENTS):
        spent += _POP[x[:, (start + k) % SEGMENTS]]
        alive &= spent * SEGMENTS <= (k + 1) * bits
    return alive


def bucket_edges(fps: np.ndarray, start: int, bits: int = BITS, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Edges among distinct fingerprints that agree in two segments from start on: enough to connect all pairs whose chain begins there.

    A large bucket is divided by pigeonhole over the bits that remain (one of bits + 1 parts is equal in any linked pair), and each part by its
    further bits, until the parts are small; parts that all bits divide hold one fingerprint, so this ends.
    """
    root, us, vs = list(range(len(fps))), [], []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def link(i: np.ndarray, j: np.ndarray) -> None:
        """Notes those of these pairs that keep their chains' budgets and connect what wasn't connected in this bucket."""
        keep = _chain(fps[i], fps[j], start, bits)
        for x, y in zip(i[keep].tolist(), j[keep].tolist(), strict=True):
            p, q = top(x), top(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                us.append(x)
                vs.append(y)

    work = [(np.arange(len(fps)), tuple((start + k) % SEGMENTS for k in range(2, SEGMENTS)))]
    view = fps.view(np.uint8).reshape(-1, 8)
    while work:
        own, free = work.pop()
        if len(own) <= small:
            i, j = np.triu_indices(len(own), 1)
            link(own[i], own[j])
        elif len(free) <= bits:  # fewer segments than errors; such members differ in few bytes only, and are compared strip by strip
            for k in range(1, len(own)):
                link(own[:-k], own[k:])
        else:
            for part in (free[k :: bits + 1] for k in range(bits + 1)):
                value = np.zeros(len(own), np.int64)
                for s in part:
                    value = value << 8 | view[own, s]
                order = np.argsort(value, kind="stable")
                work += [(own[g], tuple(s for s in free if s not in part)) for g in np.split(order, np.flatnonzero(np.diff(value[order])) + 1) if len(g) > 1]
    return fps[us], fps[vs]


def edges(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v, kind) fingerprints at most bits apart that connect all such pairs; distinct has each fp once for each kind, if it has kinds. Right for bits up to 3."""
    if not 0 <= bits <= 3:
        raise ValueError("the ring of eight segments serves distances up to 3")

    def run(batches):
        held_key, held = None, []
        found: list[tuple[int, np.ndarray, np.ndarray]] = []

        def close() -> None:
            if held_key is not None:
                own = np.concatenate(held)
                if len(own) > 1:
                    found.append((held_key >> 24, *bucket_edges(own, held_key >> 16 & 255, bits)))

        def out() -> pa.RecordBatch:
            kind = np.repeat([k for k, _, _ in found], [len(u) for _, u, _ in found]).astype(np.int32)
            return batch(u=(pa.array(np.concatenate([u for _, u, _ in found])), None), v=(pa.array(np.concatenate([v for _, _, v in found])), None), kind=(pa.array(kind), None))

        for b in batches:
            key, fp = b.column("key").to_numpy(), b.column("fp").to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if key[s] != held_key:
                    close()
                    held_key, held = int(key[s]), []
                held.append(fp[s:e])
            if found:
                yield out()
                found.clear()
        close()
        if found:
            yield out()

    spark = distinct.sparkSession
    at = [F.shiftrightunsigned("fp", 8 * s).bitwiseAND(255) for s in range(SEGMENTS)]
    kind = F.col("kind") if "kind" in distinct.columns else F.lit(0)
    keys = F.array(*[(kind * (1 << 24) + (s << 16) + at[s] * 256 + at[(s + 1) % SEGMENTS]).cast("int") for s in range(SEGMENTS)])
    dealt = distinct.select("fp", F.explode(keys).alias("key")).repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "u long, v long, kind int")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id that can be reached over links."""
    rows = stage(fingerprints(df, id_col, text_col, shingle), "simhash")
    firsts = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(edges(firsts.select("fp"), bits))
    named = firsts.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


#: Of near_copies: words of a shingle and the least share of common shingles.
COPY_SHINGLE, COPY_SIMILARITY = 5, 0.8
#: Bands of MinHashes and values in each: a pair at similarity s has no band in common with probability (1 - s ** ROWS) ** BANDS, 0.2 % at 0.8 and 0.003 % at 0.85.
BANDS, ROWS = 20, 6
#: Texts and shingles in a slice of a group, on average at most; a cell that is compared at once holds two slices.
SLICE, SLICE_SHINGLES = 2048, 1 << 21
_MULTIPLY = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(SEED + 1).integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each of them."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def shingles(text: str, size: int = COPY_SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's shingles in their order; a text of fewer words has one, of its words."""
    import xxhash

    words, digest = text.lower().encode().split(), xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    own, x = np.array([digest(w, SEED) for w in words], np.uint64), np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        x = _mix(x + own[k : len(words) - size + 1 + k] + np.uint64(k))
    return x


def bands(text: str, size: int = COPY_SHINGLE) -> np.ndarray:
    """A number for each band of MinHashes of the set of a text's shingles."""
    x = shingles(text, size)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for k in range(0, len(x), 4096):
        least = np.minimum(least, (_MULTIPLY[:, None] * x[k : k + 4096] + _ADD[:, None]).min(1))
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = _mix(out + column)
    return out.view(np.int64)


def alike(sets: list[np.ndarray], query: np.ndarray, target: np.ndarray, known: np.ndarray, similarity: float = COPY_SIMILARITY) -> list[tuple[int, int]]:
    """Pairs (query, target) at similarity or more, fewer than there are sets, that with the known components connect all such pairs.

    Each query is counted against all targets at once, by lists of the targets that have a shingle; only the counters stay in memory.
    """
    own, sizes = np.flatnonzero(target), np.fromiter(map(len, sets), np.int64, len(sets))
    names, inverse = np.unique(np.concatenate([sets[i] for i in own]), return_inverse=True)
    holder = np.repeat(np.arange(len(own)), sizes[own])[np.argsort(inverse, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(names)))])
    label, out = np.unique(known, return_inverse=True)[1], []
    for q in np.flatnonzero(query).tolist():
        if (label[own] == label[q]).all():
            continue
        at = np.minimum(np.searchsorted(names, sets[q]), len(names) - 1)
        at = at[names[at] == sets[q]]
        n = starts[at + 1] - starts[at]
        place = np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(holder[place], minlength=len(own))
        for t in own[common >= similarity * (sizes[q] + sizes[own] - common)].tolist():
            if label[t] != label[q]:
                label[label == label[t]] = label[q]
                out.append((q, t))
    return out


def _compared(cells: DataFrame, similarity: float) -> DataFrame:
    """(u, v): known components linked in each cell (g, i, j) of rows c (known component), query, target and s (set, as bytes)."""

    def run(batches):
        held_key, held = None, []

        def close() -> pa.RecordBatch | None:
            found = alike([np.frombuffer(h[3], "<u4") for h in held], np.array([h[1] for h in held]), np.array([h[2] for h in held]), np.array([h[0] for h in held]), similarity) if any(h[2] for h in held) else []
            return batch(u=([held[q][0] for q, _ in found], pa.int64()), v=([held[t][0] for _, t in found], pa.int64())) if found else None

        for b in batches:
            keys = zip(*(b.column(k).to_pylist() for k in "gij"), strict=True)
            for key, row in zip(keys, zip(*(b.column(k).to_pylist() for k in ("c", "query", "target", "s")), strict=True), strict=True):
                if key != held_key:
                    if held and (out := close()) is not None:
                        yield out
                    held_key, held = key, []
                held.append(row)
        if held and (out := close()) is not None:
            yield out

    by = ["g", "i", "j"]
    return cells.select(*by, "c", "query", "target", "s").repartition(shuffle_partitions(cells.sparkSession), *by).sortWithinPartitions(*by).mapInArrow(run, "u long, v long")


def _each(n) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def compare(rows: DataFrame, links: DataFrame, similarity: float = COPY_SIMILARITY, size: int = SLICE, shingles: int = SLICE_SHINGLES) -> list[DataFrame]:
    """Components of links and of the pairs at similarity or more inside the groups, in steps: each table (node, component) renames the components of the one before, the first those of links.

    rows: (t, g, s), a text, its group and its set as bytes. A group of up to a slice is one cell. In a larger one the texts of the first slice are held against all its
    texts first, which joins most copies in linear time; then those outside the largest component that has come of it are held against all, slice by slice. So a pair is
    compared, or one component has both. What a step finds are edges between the components before it, a far smaller graph than all links.
    """

    def slices(n, s):
        return F.greatest(F.ceil(n / size), F.ceil(s / (4 * shingles)), F.lit(1)).cast("int")

    counts = F.count("*"), F.sum(F.octet_length("s"))
    steps = [components(links)]
    now = renamed(rows.withColumn("c", F.col("t")), "c", steps[0])
    groups = checkpoint(now.groupBy("g").agg(slices(*counts).alias("k"), F.min("c").alias("a"), F.max("c").alias("b")).filter("a <> b").select("g", "k"))
    now = now.join(groups, "g")
    yes, no, none = F.lit(True), F.lit(False), F.lit(0)
    one = now.filter("k = 1").select("g", none.alias("i"), none.alias("j"), "c", yes.alias("query"), yes.alias("target"), "s")
    large = now.filter("k > 1").withColumn("own", F.pmod(F.xxhash64("t"), "k").cast("int"))
    some = not groups.filter("k > 1").isEmpty()
    if some:
        heads = large.filter("own = 0").select("g", none.alias("i"), _each(F.col("k")).alias("j"), "c", yes.alias("query"), no.alias("target"), "s")
        one = one.union(heads).union(large.select("g", none.alias("i"), F.col("own").alias("j"), "c", no.alias("query"), yes.alias("target"), "s"))
    steps.append(components(_compared(one, similarity)))
    if not some:
        return steps
    large = renamed(large, "c", steps[1])
    main = large.groupBy("g", "c").count().groupBy("g").agg(F.max_by("c", F.struct("count", "c")).alias("main"))
    large = large.join(main, "g")
    left = large.filter("c <> main and own <> 0")
    rest = checkpoint(left.groupBy("g").agg(slices(*counts).alias("r")))
    queries = left.join(rest, "g").select("g", F.pmod(F.xxhash64("t", F.lit(1)), "r").cast("int").alias("i"), _each(F.col("k")).alias("j"), "c", yes.alias("query"), no.alias("target"), "s")
    targets = large.join(rest, "g").select("g", _each(F.col("r")).alias("i"), F.col("own").alias("j"), "c", no.alias("query"), yes.alias("target"), "s")
    steps.append(components(_compared(queries.union(targets), similarity)))
    return steps


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = COPY_SIMILARITY, size: int = SLICE) -> DataFrame:
    """(doc_id, text_hash, component_id): documents are linked by SHINGLE-word fingerprints at most BITS apart, or by similarity or more of their COPY_SHINGLE-word shingles.

    For the second kind, texts with a band of MinHashes in common are in one group, and compare() holds the members of a group against each other by whole sets of shingles.

    Nulls, empty texts, words and repeated rows are as in groups(); empty texts have one shingle in common. A text of any length is one set of 4 bytes for a word.
    Ties do not arise: a component is a set. An empty table gives an empty one; other columns are ignored.
    """

    def make():
        worker_state("simhash", object)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            own = b.column("text").to_pylist()
            fp = np.array([fingerprint(t) for t in own], np.uint64).view(np.int64)
            found = pa.array([bands(t) for t in own], pa.list_(pa.int64()))
            return batch(doc_id=(b.column("doc_id"), None), text_hash=(b.column("text_hash"), None), fp=(pa.array(fp), None), bands=(found, None))

        return one

    source = texts(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    rows = stage(map_batches(source, make, "doc_id long, text_hash long, fp long, bands array<long>"), "near-copies")
    different = stage(rows.groupBy("text_hash").agg(F.min("doc_id").alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "near-copies-texts")
    heads = checkpoint(different.groupBy("fp").agg(F.min("text_hash").alias("head")))
    end = lambda k: heads.select(F.col("fp").alias(k), F.col("head").alias(f"h{k}"))
    same = different.join(heads, "fp").select(F.col("text_hash").alias("u"), F.col("head").alias("v"))
    joined = edges(heads.select("fp")).join(end("u"), "u").join(end("v"), "v").select(F.col("hu").alias("u"), F.col("hv").alias("v"))
    links = checkpoint(same.union(joined).filter("u <> v"))
    dealt = different.select(F.col("text_hash").alias("u"), F.explode("bands").alias("key"))
    firsts = dealt.groupBy("key").agg(F.min("u").alias("v"), F.count("*").alias("n")).filter("n > 1")
    group = checkpoint(components(dealt.join(firsts, "key").select("u", "v")).withColumnsRenamed({"node": "text_hash", "component": "g"}))

    def sets():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            own = [np.unique((shingles(t) >> np.uint64(32)).astype("<u4")).tobytes() for t in b.column("text").to_pylist()]
            return batch(t=(b.column("text_hash"), None), g=(b.column("g"), None), s=(own, pa.binary()))

        return one

    asked = different.join(group, "text_hash").select("text_hash", "g", F.coalesce("first", F.lit(0)).alias("k"), F.col("first").isNull().alias("none"))
    keyed = source.select("text_hash", F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("none"), "text")
    wanted = keyed.join(asked, ["text_hash", "k", "none"]).dropDuplicates(["text_hash", "k", "none"])  # one exchange serves both
    held = stage(map_batches(wanted.select("text_hash", "g", "text"), sets, "t long, g long, s binary"), "near-copies-sets")
    make_room(df.sparkSession)
    named = different.select("text_hash", "first", F.col("text_hash").alias("root"))
    for step in compare(held, links, similarity, size):
        named = renamed(named, "root", step)
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.select("doc_id", "text_hash").join(named.join(least, "root").select("text_hash", "component_id"), "text_hash").select("doc_id", "text_hash", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = groups(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
