"""Licences, media, tokens, packing and byte-level BPE against brute force."""

import hashlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from contigforge.llm import bpe, licenses, media, packing, tokenfiles
from contigforge.llm.common import shared_dir, tokenizer_path


def test_expressions():
    assert licenses.to_postfix("MIT OR Apache-2.0 AND BSD-3-Clause") == ["MIT", "Apache-2.0", "BSD-3-Clause", "and", "or"]
    assert licenses.to_postfix("(MIT OR Apache-2.0) AND GPL-2.0 WITH Classpath-exception-2.0") == ["MIT", "Apache-2.0", "or", "GPL-2.0", "Classpath-exception-2.0", "with", "and"]
    assert licenses.to_postfix("OR MIT") is None and licenses.to_postfix("(MIT") is None and licenses.to_postfix("") is None
    assert licenses.to_postfix("MIT and see the file") == ["MIT"] and licenses.to_postfix("banana") is None and licenses.to_postfix("MIT or banana") == ["MIT"]
    assert licenses.to_postfix("GPL-2.0+ WITH GCC-exception-3.1 or (ISC and Zlib) */") == ["GPL-2.0+", "GCC-exception-3.1", "with", "ISC", "Zlib", "and", "or"]
    assert licenses.to_postfix("LicenseRef-own") == ["LicenseRef-own"] and licenses.to_postfix("(MIT or (ISC") is None
    labels, free = licenses.evaluate(licenses.to_postfix("MIT OR GPL-3.0-or-later"))
    assert labels == {"mit", "gpl"} and free == licenses.FREEDOM["mit"]
    assert licenses.evaluate(licenses.to_postfix("MIT AND GPL-3.0"))[1] == licenses.FREEDOM["gpl"]


def test_licences_by_brute_force(spark, docs):
    make, odd = docs
    more = [(20, "cc by CC-BY cc  by, the General\nPublic license all rights reserved", "a"), (21, "accc by general public licenses", "a"), (22, "cc by cc by", "a"), (23, "# SPDX-License-Identifier: banana\n# SPDX-License-Identifier: MIT and see the file", "a"), (24, " ".join(licenses.NOTICES), "a")]
    got = licenses.scan(make(odd + more)).collect()
    assert len(got) == len(odd) + len(more)
    by_id = {r.doc_id: r for r in got}
    for i, text, _ in odd + more:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        r = by_id[i]
        if i is not None:
            assert (r.n_words, r.n_base) == (len(words), len(places)), i
            assert r.first_word == min((k for k, _ in places), default=None) and r.last_word == max((k for k, _ in places), default=None)
            assert r.base_labels == ",".join(sorted({x for _, x in places}))
            known = {label for phrase, label in {**licenses.BASE, **licenses.NOTICES}.items() if f" {phrase} " in f" {' '.join(words)} "}
            for tail in re.findall(r"(?i)SPDX-License-Identifier:([^\n]*)", text or ""):
                if postfix := licenses.to_postfix(tail):
                    known |= licenses.evaluate(postfix)[0]
            assert r.labels == ",".join(sorted(known)), i
    assert {"mit", "gpl", "bsd", "with:classpath-exception-2.0"} <= set(by_id[8].labels.split(","))
    assert licenses.scan(make([])).count() == 0


def test_media_round_trip(spark, docs):
    make, odd = docs
    got = media.round_trip(make(odd)).collect()
    assert len(got) == len(odd)
    for r in got:
        texts = [t for i, t, _ in odd if i == r.doc_id]
        raw = (texts[0] or "").encode() if r.doc_id is not None else None
        if raw is not None:
            payload = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
            assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload)) and r.payload_sha256 == hashlib.sha256(payload).hexdigest()
            assert r.tail_crc32 == zlib.crc32(payload[-64:]) and r.media_sha256 == hashlib.sha256(media.wav(payload)).hexdigest()
    assert media.round_trip(make([])).count() == 0


def png(body=b"x" * 40):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def test_sniffing(spark):
    wav, gz = media.wav(b"abcd" * 16), zlib.compressobj(wbits=31)
    zipped = gz.compress(b"hello") + gz.flush()
    gif = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + b"\x2c" + bytes(8) + b"\0" + b"\x02\x02\x44\x01\0\x3b"
    bmp = b"BM" + struct.pack("<IIII", 58, 0, 54, 40) + bytes(40)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x04cd\x01\x02\xff\x00\xff\xd9"
    pdf = b"%PDF-1.4\n1 0 obj\n%%EOF"
    ogg = b"OggS\0\x06" + bytes(20) + b"\x01\x03abc"
    box = b"PK\3\4" + bytes(26)
    archive = box + b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0, 0, 0, len(box), 0)
    s = media.Sniffer()
    for content, kind in ((wav, "audio/wav"), (zipped, "application/gzip"), (gif, "image/gif"), (png(), "image/png"), (jpeg, "image/jpeg"), (pdf, "application/pdf"), (ogg, "audio/ogg"), (archive, "application/zip"), (bmp[:58], "image/bmp")):
        assert s.inspect(content, "text/plain")[:2] == (kind, True), kind
        assert s.inspect(content[: len(content) // 2], None)[0] != kind  # cut short: not confirmed
    broken = png()[:-6] + b"\0" + png()[-5:]
    assert s.inspect(broken, None)[0] == media.UNKNOWN
    rows = [(1, b"head" + png() + b"mid" + wav, "image/png"), (2, None, None), (3, b"plain text BM", "text/plain"), (1, b"", "x")]
    got = media.inspect(spark.createDataFrame(rows, "id int, content binary, declared string"), "id", "content", "declared").collect()
    one = next(r for r in got if r.id == 1 and r.n_bytes)
    assert [(c.media_type, c.start, c.length) for c in one.carved] == [("image/png", 4, len(png())), ("audio/wav", 7 + len(png()), len(wav))] and bytes(one.carved[0].content) == png()
    assert next(r for r in got if r.id == 3).media_type == "text/plain" and len(got) == 4


def test_sniffing_ends():
    """A saved-again PDF is whole, an archive in an archive ends where its own directory does, and pages inside a stream are no stream."""
    s = media.Sniffer()
    body = b"%PDF-1.4\n1 0 obj\nendobj\n"
    first = body + b"xref\n0 1\ntrailer\nstartxref\n%d\n%%%%EOF\n" % len(body)
    again = first + b"2 0 obj\nendobj\n"
    again += b"xref\n0 1\ntrailer\nstartxref\n%d\n%%%%EOF" % len(again)
    assert s.find(again) == [("application/pdf", 0, len(again))] and s.find(b"ab" + first + again)[:2] == [("application/pdf", 2, len(first) + 1), ("application/pdf", 2 + len(first), 2 + len(first) + len(again))]
    pack = lambda inner: b"PK\3\4" + bytes(26) + inner + b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0, 0, 0, 30 + len(inner), 0)
    inner = pack(b"")
    assert s.find(pack(inner)) == [("application/zip", 0, 52 + len(inner)), ("application/zip", 30, 30 + len(inner))]
    page = lambda flag: b"OggS\0" + bytes([flag]) + bytes(20) + b"\x01\x03abc"
    stream = page(2) + page(0) * 3 + page(4)
    assert s.find(stream) == [("audio/ogg", 0, len(stream))]


@pytest.mark.parametrize("unit", [b"%PDF-", b"PK\3\4", b"OggS\0\2" + bytes(20) + b"\0", b"GIF89a\1\0\1\0\0\0\0\x2c" + bytes(8) + b"\0\2\4", b"\xff\xd8\xff\xda\0\2", b"\x1f\x8b\x08", b"RIFF\0\0\1\0WAVE"])
def test_hostile_contents(unit):
    import time

    content = unit * (3_000_000 // len(unit))
    began = time.perf_counter()
    media.Sniffer().inspect(content + b"obj %%EOF", None)
    assert time.perf_counter() - began < 30


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
@pytest.mark.parametrize("high", [1, 2, 50_000, 2**32 - 1])
def test_frame_of_reference(n, high):
    x = np.random.default_rng(n).integers(0, high, n, dtype=np.uint32)
    x[::13] = high - 1
    b = tokenfiles.Blocks(tokenfiles.encode_blocks(x))
    assert (b.all() == x).all() and all((b.block(i) == x[128 * i : 128 * i + 128]).all() for i in range(b.blocks))


#: Texts that spell out added tokens.
SPELT = [(90, "a <|endoftext|> b", "s"), (91, "<|startoftext|><|ENDOFTEXT|> x<|endoftext|>", None)]


def test_token_files(spark, docs, monkeypatch):
    make, odd = docs
    monkeypatch.setattr(tokenfiles, "SEGMENT_IDS", 500)
    vocabulary = tokenizer_path("word_bpe_49k.json")
    path = f"{shared_dir(spark)}/test-tokens"
    tokenfiles.write(make(odd + SPELT), path, vocabulary, 2)
    got = sorted(tokenfiles.read(spark, path).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(vocabulary)
    want = sorted(((-1 if i is None else i, x or "") for i, x, _ in odd + SPELT))
    at = 0
    assert [r.doc_id for r in got] == [None if i < 0 else i for i, _ in want]
    for r, (_, text) in zip(got, want, strict=True):
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        assert (r.start, list(r.ids)) == (at, ids)
        at += len(ids)
    digest = {r.start: r for r in tokenfiles.digest(spark, path).collect()}
    assert all(digest[r.start].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    empty = f"{shared_dir(spark)}/test-no-tokens"
    tokenfiles.write(make([]), empty, vocabulary, 2)
    assert tokenfiles.read(spark, empty).count() == 0


@pytest.mark.parametrize("totals", [[5], [0, 7], [1000, 1, 0, 37], [12345, 345, 9999, 1, 0, 777]])
def test_schedule(totals):
    s, r = packing.Schedule(totals, 64, 8), np.random.default_rng(1)
    places, served = {}, {}
    for q, total in enumerate(totals):
        at = 0
        while at < total:
            n = int(min(total - at, r.integers(1, 900)))
            start, length, sequence, offset = (x.tolist() for x in s.pieces(q, at, n))
            assert start == [sum(length[:i]) for i in range(len(length))] and sum(length) == n
            for k, w, o in zip(length, sequence, offset, strict=True):
                places.setdefault(w, []).append((o, k))
                served[w, q] = served.get((w, q), 0) + k
            at += n
    for w, parts in places.items():
        at = 0
        for o, k in sorted(parts):
            assert o == at
            at += k
        assert at == 64 or at & (at - 1) == 0
        if at == 64:
            assert all(abs(served.get((w, q), 0) - 64 * t / sum(totals)) <= 2 for q, t in enumerate(totals))


def test_schedule_of_targets():
    """Weights set the shares until a queue is dry; then the others go on in their proportions."""
    totals, weights = [4000, 9000, 100, 0], [1, 2, 1, 5]
    s = packing.Schedule(totals, 64, 4, weights)
    before = np.zeros(4, np.int64)
    for n in range(1, sum(totals) + 1):
        now = s._given(n)
        assert now.sum() == n and (now >= before).all() and (now <= totals).all()
        before = now
    served = np.diff(np.concatenate([s.counts(b)[: 1 if b + 1 < s.blocks else None] if b + 1 == s.blocks else s.counts(b)[:-1] for b in range(s.blocks)]), axis=0)
    assert (np.abs(served[:5] - 64 * np.array([1, 2, 1, 0]) / 4) <= 2).all() and (np.abs(served[10:150] - 64 * np.array([1, 2, 0, 0]) / 3) <= 3).all()
    for q, total in enumerate(totals[:3]):
        assert sum(int(s.pieces(q, at, min(777, total - at))[1].sum()) for at in range(0, total, 777)) == total


def test_schedule_of_many_sources():
    import time

    r = np.random.default_rng(3)
    s = packing.Schedule((r.pareto(1.0, 20_000) * 1000 + 1).astype(int).tolist())
    began = time.perf_counter()
    assert (np.diff(s.counts(1), axis=0).sum(1) == 1024).all()
    assert time.perf_counter() - began < 5


def test_packing_targets_and_wide_ids(spark, docs, tmp_path):
    import json

    make, _ = docs
    path = str(tmp_path / "wide.json")
    with open(tokenizer_path("byte_bpe_50k.json")) as f:
        vocabulary = json.load(f)
    vocabulary["model"]["vocab"]["Ġtwo"] = 70_000
    with open(path, "w") as f:
        json.dump(vocabulary, f)
    rows = [(i, "one two " * 50, "ab"[i % 2]) for i in range(40)]
    tokens = packing.tokenise(make(rows), path).collect()
    assert all(np.frombuffer(x.ids, "<u4")[1] == 70_000 and len(x.ids) == 4 * x.n_tokens for x in tokens)
    got = packing.pack(make(rows), path, 64, 4, mixture={"a": 0.75, "b": 0.25}).filter("sequence_id < 10").groupBy("source").sum("length").collect()
    assert {x.source: round(x[1] / 64) for x in got} in ({"a": 7, "b": 3}, {"a": 8, "b": 2})


def test_packing(spark, docs):
    make, odd = docs
    vocabulary = tokenizer_path("byte_bpe_50k.json")
    got = packing.pack(make(odd + SPELT), vocabulary, 256, 4).collect()
    t = Tokenizer.from_file(vocabulary)
    want = sorted(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x, _ in odd + SPELT)
    assert sorted(r.doc_tokens for r in got if r.start == 0) == want and sum(r.length for r in got) == sum(want)
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        size = sum(k for _, k in parts)
        assert size == 256 or size & (size - 1) == 0
    ids = t.encode("word " * 30_000, add_special_tokens=False).ids + [0]
    for r in got:
        if r.doc_id == 6:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert packing.pack(make([]), vocabulary).count() == 0


def test_bpe(spark, docs):
    make, odd = docs
    more = [(30 + i, t, "a") for i, t in enumerate(["x" * 3000, "a  b", " a", "don't I'll 's", "\n \n x", "12345 ½²", "İß", "tab\there  "])]
    ranks = bpe.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = make(odd + more)
    texts = {i: t or "" for i, t, _ in odd + more}
    encoded = bpe.encode(rows)
    for r in encoded.collect():
        if r.doc_id is not None:
            assert list(r.ids) == own.encode_ordinary(texts[r.doc_id])
    assert all(bytes(r.content).decode() == texts[r.doc_id] for r in bpe.decode(encoded).collect() if r.doc_id is not None)
    for r in bpe.digest(rows).collect():
        if r.doc_id is not None:
            ids = own.encode_ordinary(texts[r.doc_id])
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    assert bpe.digest(make([])).count() == 0
