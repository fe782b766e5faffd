"""Fingerprints, repeats, SimHash, lines, quality and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from contigforge.llm import common, components, fingerprints, linededup, quality, simhash, suffixes


def sketch(text):
    words = [w for w in re.split("[ \t\n\r\x0b\f]+", text) if w]
    shingles = [words[i : i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [[" ".join(words)]] if words else []
    out = set()
    for s in shingles:
        h = 42
        for w in s:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        if h >> 62 == 0:
            out.add(h >> 22)
    return out


def test_fingerprints(spark, docs, monkeypatch):
    make, odd = docs
    r = random.Random(5)
    many = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 60))), "a") for i in r.sample(range(5000), 300)] + [(7000, None, "a"), (7001, "", "a"), (7002, "one", "a")]
    got = {x.doc_id: x for x in fingerprints.compare_edited(make(many)).collect()}
    texts = {i: t or "" for i, t, _ in many}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, after, g = texts[i], texts[order[(k + 1) % len(order)]], got[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = sketch(text), sketch(edited), sketch(after)
        assert g.n_chars == len(text) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert g.fingerprint[16:] == "".join(f"{x:010x}" for x in sorted(a))
        like = lambda p, q, x, y: 1.0 if x == y else len(p & q) / len(p | q) if p | q else 0.0
        assert g.near_edited == pytest.approx(like(a, b, text, edited)) and g.near_next == pytest.approx(like(a, c, text, after))
    hard = fingerprints.compare_edited(make(odd)).collect()
    assert len(hard) == len(odd) and all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in hard)
    assert len({x.fingerprint for x in hard if x.doc_id in (4, 5)}) == 1
    assert fingerprints.compare_edited(make([])).count() == 0
    assert fingerprints.compare_edited(make(["a single text of some words"])).first().near_next == 1


@pytest.mark.parametrize("ids", ["sparse", "none", "hot", "mixed"])
def test_fingerprints_neighbours(spark, docs, monkeypatch, ids):
    """Ids far apart, rows without an id, one id on a third of the rows: neighbours are those of the whole order, and no group is large."""
    make, _ = docs
    monkeypatch.setattr(fingerprints, "NEIGHBOURS", 8)
    r = random.Random(13)
    text = lambda: " ".join(r.choice("abcdefgh") for _ in range(r.randint(5, 20)))
    key = {"sparse": lambda i: r.randrange(-(2**62), 2**62), "none": lambda i: None, "hot": lambda i: 5 if i % 3 else i, "mixed": lambda i: i if i % 50 else 2**60 + i}[ids]
    rows = [(key(i), text(), "a") for i in range(400)]
    found = fingerprints.with_next(make(rows))
    sizes = [x["count"] for x in found.groupBy("grp").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 60
    got = sorted((x.k, x.text_hash, x.n_chars, x.edited_sha256) for x in _keyed(make(rows)).collect())
    order = sorted((x.k, x.text_hash, x.text) for x in found.filter("guest = 0").collect())
    for (k, h, n, sha), (k2, h2, t), after in zip(got, order, [order[-1], *order], strict=False):
        half = len(t) // 2
        assert (k, h, n) == (k2, h2, len(t)) and sha == hashlib.sha256((t[: len(t) - half] + after[2][:half]).encode()).hexdigest()


def _keyed(frame):
    from pyspark.sql import functions as F

    whole = fingerprints.compare_edited(frame)
    hashes = frame.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), F.xxhash64("text").alias("text_hash"), F.lower(F.lpad(F.hex(F.xxhash64("text")), 16, "0")).alias("head")).distinct()
    return whole.withColumn("k", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("head", F.substring("fingerprint", 1, 16)).join(hashes, ["k", "head"])


def test_sketches_merge(spark):
    from pyspark.sql import functions as F

    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(40))
    row = spark.createDataFrame([(a, b)], "a string, b string").select(*[fingerprints.sketch(F.col(c)).alias(c) for c in "ab"])
    x = row.select("a", "b", fingerprints.merge(F.col("a"), F.col("b")).alias("m")).select("*", fingerprints.containment(F.col("b"), F.col("m")).alias("bm"), fingerprints.containment(F.col("a"), F.col("b")).alias("ab")).first()
    assert x.m == sorted({*x.a, *x.b}) and x.bm == 1 and x.ab == 0 and 60 <= len(x.a) <= 140


def test_merge_derives_common_prefixes():
    r = random.Random(11)
    strings = ["".join(r.choice("ab") for _ in range(r.randint(12, 40))).encode() for _ in range(30)]
    shards = [suffixes.ShardTransform(strings[i : i + 7]) for i in range(0, 30, 7)]
    for length in (3, 12):
        shard, string, place, common = suffixes.merge(shards, length)
        rows = [strings[7 * a + b][c:] for a, b, c in zip(shard.tolist(), string.tolist(), place.tolist(), strict=True)]
        assert [x[:length] for x in rows] == sorted(x[:length] for x in rows) and len(rows) == sum(map(len, strings)) + 30
        for x, y, k in zip(rows, rows[1:], common[1:].tolist(), strict=False):
            assert k == next((i for i in range(length) if i >= min(len(x), len(y)) or x[i] != y[i]), length)


def test_repeats_without_ids(spark, docs):
    """Rows without an id, or all of one id, lie in many chunks and take nothing from each other, but from smaller ids."""
    make, _ = docs
    r = random.Random(12)
    passage = "".join(r.choice("abcdefgh ") for _ in range(80))
    rows = [(None, f"{i} {passage} {i}", "a") for i in range(20)] + [(7, f"{i} {passage}", "a") for i in range(20, 30)]
    got = suffixes.digest(make(rows)).collect()
    assert all(x.n_removed >= 80 for x in got if x.doc_id is None) and all(x.n_removed == 0 for x in got if x.doc_id == 7)
    assert suffixes.digest(make([(None, f"{i} {passage}", "a") for i in range(20)])).filter("n_removed > 0").count() == 0


def repeats(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if seen.setdefault(raw[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [0, 1, 10**6])
def test_repeats(spark, docs, monkeypatch, hot):
    make, _ = docs
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcde é") for _ in range(r.randint(1, 9)))
    base = [" ".join(word() for _ in range(40)) for _ in range(6)]
    rows = []
    for i in r.sample(range(1000), 40):
        t = " ".join(r.choice([*base, word(), base[0][: r.randint(20, 90)], base[1][r.randint(0, 60) :]]) for _ in range(r.randint(0, 6)))
        rows.append((i, t))
    monkeypatch.setattr(suffixes, "CHUNK_DOCUMENTS", 7)
    got = suffixes.digest(make([(i, t, "a") for i, t in rows]), hot=hot).collect()
    want = repeats(rows)
    assert len(got) == len(rows)
    for g in got:
        assert tuple(g)[1:] == want[g.doc_id], g.doc_id
    assert sum(w[1] for w in want.values()) > 0


def test_repeats_hard_cases(spark, docs):
    make, odd = docs
    frame = make(odd)
    got = suffixes.digest(frame).collect()
    assert len(got) == len(odd)
    same = sorted((g.doc_id is None, g.doc_id, g.n_removed) for g in got if g.n_bytes == 207)
    assert [x[2] for x in same] == [0, 207, 207, 207]  # the least id keeps it
    cut = suffixes.remove_repeats(frame)
    assert cut.columns == frame.columns and cut.count() == len(odd)
    assert cut.filter("text is null").count() == 2 and suffixes.digest(make([])).count() == 0


def test_merge_of_shards():
    r = random.Random(3)
    for t in range(8):
        base = bytes(r.choice(b"ab") for _ in range(300)) if t % 2 else bytes(r.randrange(256) for _ in range(300))
        strings = list({base[(a := r.randrange(200)) : a + r.randint(50, 80)] for _ in range(40)})
        ids, best = np.array([r.randrange(99) for _ in strings]), {}
        for s, i in zip(strings, ids, strict=True):
            for k in range(len(s) - 49):
                best[s[k : k + 50]] = min(best.get(s[k : k + 50], 999), i)
        for s, g in zip(strings, suffixes.least_ids(strings, ids, 50, 7), strict=True):
            assert [best[s[k : k + 50]] for k in range(len(s) - 49)] == g.tolist()


def bits(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs):
    make, odd = docs
    r = random.Random(4)
    text = " ".join(r.choice("the of and to in is".split()) + str(r.randrange(50)) for _ in range(400)).split()
    rows = list(odd)
    for i in range(100, 140):
        t = list(text)
        for _ in range(r.randint(0, 6)):
            t[r.randrange(len(t))] = "new"
        rows.append((i, " ".join(t), "a"))
    got = simhash.groups(make(rows)).collect()
    fps = {}
    for i, t, _ in rows:
        fps.setdefault(bits(t or ""), []).append(i)
    nodes = list(fps)
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if bin(a ^ b).count("1") <= 3:
                root[top(a)] = top(b)
    least = {}
    for n in nodes:
        own = [i for i in fps[n] if i is not None]
        least[top(n)] = min([*own, least.get(top(n), 10**9)])
    assert len(got) == len(rows)
    for g in got:
        fp = g.fp % 2**64
        assert fp in fps and g.component_id == least[top(fp)]
    assert simhash.groups(make([])).count() == 0


@pytest.mark.parametrize("small", [2, 64])
def test_bucket_edges(small):
    r = np.random.default_rng(1)
    centre = int(r.integers(0, 2**48))
    fps = {centre}
    for _ in range(400):
        x = centre
        for b in r.choice(48, r.integers(1, 5), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    f = np.array(sorted(fps), np.int64)  # all agree in the last two segments
    u, v = simhash.bucket_edges(f, 6, 3, small)
    assert len(u) < len(f) and all(bin(int(a) ^ int(b)).count("1") <= 3 for a, b in zip(u, v, strict=True))


def test_near_copies(spark, docs):
    make, _ = docs
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(300)]
    copy = list(base)
    copy[10] = "changed"
    rows = [(1, " ".join(base), "a"), (2, " ".join(base), "a"), (3, " ".join(copy), "b"), (4, " ".join(word() for _ in range(300)), "a"), (5, None, "a"), (6, "", "a"), (None, " ".join(base), "a")]
    got = {(x.doc_id, x.component_id) for x in simhash.near_copies(make(rows)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5), (None, 1)}


@pytest.mark.parametrize("size", [simhash.SLICE, 16])
def test_near_copies_brute_force(spark, docs, size):
    """Templates whose head is unlike its members, the same words in other order, and isolated edited pairs of short texts."""
    make, _ = docs
    r = random.Random(16)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    rows = []
    for _ in range(60):
        own = [word() for _ in range(70)]
        copy = list(own)
        copy[35] = word()
        rows += [" ".join(own), " ".join(copy)]
    base = [word() for _ in range(200)]
    for _ in range(50):  # one bag of words; pairs are alike, other members are not
        order = [base[i : i + 10] for i in range(0, 200, 10)]
        r.shuffle(order)
        own = [w for part in order for w in part]
        turned = list(own)
        turned[20], turned[21] = turned[21], turned[20]
        rows += [" ".join(own), " ".join(turned)]
    long = [word() for _ in range(300)]
    for _ in range(40):  # a template with a third of its own: some 0.5 alike, and two copies of each
        own = long[:200] + [word() for _ in range(100)]
        copy = list(own)
        copy[250] = word()
        rows += [" ".join(own), " ".join(copy)]
    r.shuffle(rows)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in rows]
    got = {x.doc_id: x.component_id for x in simhash.near_copies(make(rows), size=size).collect()}
    alike = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert len(alike) >= 140 and all(got[i] == got[j] for i, j in alike)
    linked = simhash.groups(make(rows)).select("doc_id", "component_id").collect()
    root = {x.doc_id: x.component_id for x in linked}
    for i, j in sorted(alike):  # components of both kinds of links, and nothing beyond them
        a, b = root[i], root[j]
        root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    assert got == root


def test_near_copies_hard_rows(spark, docs):
    make, odd = docs
    got = simhash.near_copies(make(odd))
    assert got.count() == len(odd) and simhash.near_copies(make([])).count() == 0


def test_near_copies_recall(spark, docs):
    """Isolated pairs at 0.8 to 0.9, by whole texts of 20 to 400 words."""
    make, _ = docs
    r = random.Random(26)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    rows, pairs = [], []
    while len(pairs) < 400:
        own = [word() for _ in range(r.randint(20, 400))]
        copy = list(own)
        for _ in range(max(1, len(own) // 45)):
            copy[r.randrange(len(own))] = word()
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (own, copy))
        if 0.8 <= len(a & b) / len(a | b) < 0.9:
            pairs.append((len(rows), len(rows) + 1))
            rows += [" ".join(own), " ".join(copy)]
    got = {x.doc_id: x.component_id for x in simhash.near_copies(make(rows)).collect()}
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.99 * len(pairs)


def test_components(spark):
    r = random.Random(7)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {n: top(n) for n in root if any(n in p for p in pairs if p[0] != p[1])}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_lines(spark, docs):
    make, odd = docs
    rows = list(odd) + [(100 + i, f"own {i}\n  Shared line\t\nrare", f"s{i % 7}") for i in range(30)] + [(200, "Shared line", None), (201, "rare\n\nx", "s1"), (202, "below " + "\nfew", "s1"), (203, "few", "s2")]
    frame = make(rows)
    got = linededup.remove_lines(frame)
    assert got.columns == [*frame.columns, "_n_lines", "_n_removed"]
    sites, firsts = {}, {}
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            if key := line.strip(" \t\r"):
                sites.setdefault(key, set()).add(s)
                if i is not None:
                    firsts[key] = min(firsts.get(key, 10**9), i)
    for x in got.collect():
        texts = {t for i, t, _ in rows if i == x.doc_id}
        want = set()
        for t in texts:
            kept = [line for line in (t or "").split("\n") if not (key := line.strip(" \t\r")) or len(sites[key]) < linededup.MIN_SITES or firsts.get(key) == x.doc_id]
            want.add(None if t is None else "\n".join(kept))
        assert x.text in want
    assert got.count() == len(rows) and linededup.remove_lines(make([])).count() == 0


def test_lines_beside_clashing_names(spark, docs, tmp_path):
    from pyspark.sql import functions as F

    make, _ = docs
    rows = [(i, f"own {i}\nshared", f"s{i}") for i in range(8)]
    frame = make(rows).withColumns({"_n_lines": F.lit(1), "_n_removed": F.lit("x"), "places": F.lit(2)})
    linededup.remove_lines(frame).write.parquet(str(tmp_path / "lines"))
    got = spark.read.parquet(str(tmp_path / "lines"))
    assert got.columns == [*frame.columns, "__n_lines", "__n_removed"] and got.agg(F.sum("__n_removed")).first()[0] == 7


def test_quality_small(spark, docs):
    """A table of twenty texts is judged by the same rules as a large one."""
    make, _ = docs
    r = random.Random(19)
    say = lambda n: " ".join(r.choice("the of and a in river stone house green walk light under about nation".split()) for _ in range(n)).capitalize() + ". "
    good = ["".join(say(r.randint(5, 12)) for _ in range(8)) for _ in range(10)]
    rows = good + ["".join(say(9) for _ in range(8)).upper().replace(" ", "!! ") for _ in range(10)]
    kept = {x.doc_id: x.keep for x in quality.score(make(rows), quality.fit(make(rows))).collect()}
    assert all(kept[i] for i in range(10)) and not any(kept[i] for i in range(10, 20))


def test_quality(spark, docs):
    make, odd = docs
    r = random.Random(8)
    say = lambda n: " ".join(r.choice("the of and a in river stone house green walk light under about nation".split()) for _ in range(n)).capitalize() + ". "
    good = ["".join(say(r.randint(5, 12)) for _ in range(8)) for _ in range(300)]
    shout = [t.upper().replace(" ", "!! ") for t in good[:60]]
    rude = [t.replace("river", "idiot").replace("stone", "moron") for t in good[60:120]]
    rows = good[120:] + shout + rude
    frame = make(rows)
    scorer = quality.fit(frame)
    got = {x.doc_id: x for x in quality.score(frame, scorer).collect()}
    kept = [got[i].keep for i in range(len(rows))]
    n = len(good) - 120
    assert sum(kept[:n]) >= 0.97 * n and sum(kept[n:]) <= 0.05 * len(kept[n:])
    names = list(quality.LABELLERS)
    assert scorer.votes.accuracy()[names.index("shouting")] > 0.9
    hard = make(odd)
    assert quality.score(hard, scorer).count() == len(odd) and set(quality.keep_good(hard, scorer).columns) == set(hard.columns)
    assert not any(x.keep for x in quality.score(hard, scorer).filter("doc_id in (0, 1, 2)").collect())
    empty = quality.fit(make([]))
    assert quality.score(make(["some words"]), empty).first().keep and quality.score(make([]), empty).count() == 0


def test_quality_rare_abuse(spark, docs):
    """Toxic documents are 0.2 % of the corpus, and each has an insult of its own."""
    make, _ = docs
    r = random.Random(18)
    say = lambda n: " ".join(r.choice("the of and a in river stone house green walk light under about nation".split()) for _ in range(n)).capitalize() + ". "
    good = ["".join(say(r.randint(5, 12)) for _ in range(8)) for _ in range(5000)]
    insults = sorted(quality.INSULTS)[:10]
    rude = [good[i].replace("river", w).replace("stone", w) for i, w in enumerate(insults)]
    shout = [t.upper().replace(" ", "!! ") for t in good[100:400]]
    frame = make(good[400:] + shout + rude)
    kept = {x.doc_id: x.keep for x in quality.score(frame, quality.fit(frame)).collect()}
    n = len(good) - 400
    assert not any(kept[n + 300 + i] for i in range(10))
    assert sum(kept[i] for i in range(n)) >= 0.97 * n and sum(kept[n + i] for i in range(300)) <= 15


def test_pipeline(spark, docs, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    make, odd = docs
    r = random.Random(9)
    word = lambda: r.choice("the of and a in is to".split()) if r.random() < 0.4 else "".join(r.choice("abcdefghij") for _ in range(6))
    text = lambda: " ".join(" ".join(word() for _ in range(9)).capitalize() + "." for _ in range(12))
    clean = [(300 + i, text(), f"s{i % 5}") for i in range(60)]
    copies = [(400 + i, clean[i][1], "s9") for i in range(10)]
    make(clean + copies + odd).write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    one = pipeline.classify(spark, frame, "")
    assert set(pipeline.COLUMNS) == set(one.columns) and one.filter("doc_id between 310 and 359").count() == 50
    three = pipeline.near_copies(spark, frame, "")
    ids = [x.doc_id for x in three.select("doc_id").collect()]
    assert set(range(300, 360)) <= set(ids) and not any(i is not None and i >= 400 for i in ids) and len([i for i in ids if i in (4, 5)]) == 1
    out = pipeline.run(spark, str(tmp_path))
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_pipeline_stages_make_room(spark, docs, monkeypatch):
    """Before each stage and amid near copies, executors run a full collection of their own, so that no stage starts on what another left."""
    pipeline = pytest.importorskip("corpus_pipeline")
    monkeypatch.setattr(common, "release", lambda spark: None)  # the driver's own collection; here it has the executors' heap
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    full = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    for workers in (True, False):
        before = full()
        common.make_room(spark, workers)
        assert full() > before
    called, frame = [], docs[0](["a b c d e f", "a b c d e f", "g h i"])
    for module in (pipeline, simhash):
        monkeypatch.setattr(module, "make_room", lambda spark, workers=True: called.append(workers))
    counts = []
    for _, stage in pipeline.STAGES:
        called.clear()
        stage(spark, frame, "")
        counts.append(list(called))
    assert counts == [[True], [False], [True, True], [True], [True]]  # line dedup runs no Python
