"""Media columns: Aho-Corasick locates magic bytes, validators confirm structure and length, declared types are corrected and embedded media carved.

Contract of inspect() and round_trip():
- null content counts as empty: type application/octet-stream (round_trip: as an empty text), nothing is carved;
- a null declared type is no claim and is replaced; a null id stays null;
- repeated rows each give a row, an empty table gives none, other columns are ignored;
- a long content that repeats magic bytes is read about once for each kind of end mark, block or page, not once for each magic; of gzip, magic bytes
  inside a member that has been confirmed are not tried.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, documents, map_batches, texts

UNKNOWN = "application/octet-stream"


class Index:
    """What validators look up in one content, each worked out once: places of end marks, and where chains of blocks lead."""

    def __init__(self, content: bytes):
        self.content, self.places, self.memo, self.gzip_end = content, {}, {}, 0

    def all(self, pattern: bytes) -> list[int]:
        if pattern not in self.places:
            self.places[pattern] = [m.start() for m in re.finditer(pattern, self.content, re.S)]
        return self.places[pattern]

    def after(self, pattern: bytes, at: int) -> int:
        """The first match from at on, or -1."""
        found = self.all(pattern)
        i = bisect_left(found, at)
        return found[i] if i < len(found) else -1

    def follow(self, state: tuple, step: Callable[[tuple], tuple | int | None]) -> int | None:
        """The end that a chain of states comes to, None if it breaks off; states met before are not walked again."""
        path = []
        while isinstance(state, tuple) and state not in self.memo:
            path.append(state)
            state = step(state)
        end = self.memo[state] if isinstance(state, tuple) else state
        self.memo.update(dict.fromkeys(path, end))
        return end

    def owners(self, kind: str, find: Callable[[], dict[int, int]]) -> dict[int, int]:
        """The end of each object of a kind that its end mark leads back to."""
        if kind not in self.places:
            self.places[kind] = find()
        return self.places[kind]


def _png(b: bytes, at: int, ix: Index) -> int | None:
    p = at + 8
    while p + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or struct.unpack_from(">I", b, p + 8 + n)[0] != zlib.crc32(memoryview(b)[p + 4 : p + 8 + n]) or (p == at + 8) != (kind == b"IHDR"):
            return None
        p += 12 + n
        if kind == b"IEND":
            return p
    return None


def _gif(b: bytes, at: int, ix: Index) -> int | None:
    def step(state: tuple) -> tuple | int | None:
        kind, p, images = state
        if p >= len(b):
            return None
        if kind == "gif part":  # sub-blocks, up to an empty one
            return ("gif part", p + b[p] + 1, images) if b[p] else ("gif", p + 1, images)
        if b[p] == 0x3B:
            return p + 1 if images else None
        if b[p] == 0x21:
            return "gif part", p + 2, images
        if b[p] == 0x2C and p + 10 < len(b):
            return "gif part", p + 11 + (3 << ((b[p + 9] & 7) + 1) if b[p + 9] & 128 else 0), True
        return None

    return ix.follow(("gif", at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 128 else 0), False), step) if at + 13 <= len(b) else None


def _jpeg(b: bytes, at: int, ix: Index) -> int | None:
    def step(state: tuple) -> tuple | int | None:
        _, p = state
        if p + 4 > len(b) or b[p] != 0xFF:
            return None
        mark, n = b[p + 1], struct.unpack_from(">H", b, p + 2)[0]
        if mark < 0xC0 or 0xD0 <= mark <= 0xD9 or n < 2:
            return None
        p += 2 + n
        if mark == 0xDA:  # after the scan's data stands the next mark that is neither stuffing nor a restart
            p = ix.after(rb"\xff(?=[^\x00\xd0-\xd7])", p)
            if p < 0:
                return None
            if b[p + 1] == 0xD9:
                return p + 2
        return "jpeg", p

    return ix.follow(("jpeg", at + 2), step)


def _riff(b: bytes, at: int, ix: Index) -> int | None:
    if at + 12 > len(b):
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    p, kinds = at + 12, set()
    if end > len(b):
        return None
    while p + 8 <= end:
        kind, n = struct.unpack_from("<4sI", b, p)
        kinds.add(kind)
        p += 8 + n + (n & 1)
    wave = b[at + 8 : at + 12] != b"WAVE" or {b"fmt ", b"data"} <= kinds
    return end if kinds and wave and p in (end, end + 1) else None


def _bmp(b: bytes, at: int, ix: Index) -> int | None:
    if at + 54 > len(b):
        return None
    n, zero, pixels, head = struct.unpack_from("<IIII", b, at + 2)
    return at + n if zero == 0 and head in (12, 40, 52, 56, 108, 124) and 14 + head <= pixels <= n and at + n <= len(b) else None


def _gzip(b: bytes, at: int, ix: Index) -> int | None:
    def inflate(state: tuple) -> int | None:
        """The end of the member whose compressed data begin here, if their sum and size are right."""
        p = state[1]
        d, n, crc, size, view = zlib.decompressobj(-15), p, 0, 0, memoryview(b)
        try:
            while not d.eof and n < len(b):
                part = d.decompress(view[n : n + 65536])
                crc, size, n = zlib.crc32(part, crc), size + len(part), n + 65536
        except zlib.error:
            return None
        end = min(n, len(b)) - len(d.unused_data) + 8
        return end if d.eof and end <= len(b) and struct.unpack_from("<II", b, end - 8) == (crc, size & 0xFFFFFFFF) else None

    if at < ix.gzip_end or at + 18 > len(b) or b[at + 3] & 0xE0:
        return None
    flags, p = b[at + 3], at + 10
    if flags & 4:
        p += 2 + struct.unpack_from("<H", b, p)[0]
    for bit in (8, 16):  # name and comment, each ended by a zero
        if flags & bit and (p := ix.after(rb"\x00", p) + 1) == 0:
            return None
    end = ix.follow(("gzip", p + (flags & 2)), inflate) if p + (flags & 2) < len(b) else None
    ix.gzip_end = end or ix.gzip_end
    return end


def _pdf(b: bytes, at: int, ix: Index) -> int | None:
    """The last end mark whose offset leads to a cross-reference table of this file; without one, the next end mark, if no other file begins before it."""

    def find() -> dict[int, int]:
        tables, out = ix.all(rb"(?<!start)xref"), {}
        for m in re.finditer(rb"startxref\s{1,9}(\d{1,12})\s{1,9}%%EOF", b):
            if i := bisect_left(tables, m.start()):
                out[tables[i - 1] - int(m.group(1))] = m.end()
        return out

    if (end := ix.owners("pdf", find).get(at)) is not None:
        return end
    end, other = ix.after(rb"%%EOF", at), ix.after(rb"%PDF-", at + 1)
    return end + 5 if end >= 0 and not 0 <= other < end and 0 <= ix.after(rb"obj", at) < end else None


def _zip(b: bytes, at: int, ix: Index) -> int | None:
    def find() -> dict[int, int]:
        out = {}
        for end in ix.all(rb"PK\x05\x06"):
            if end + 22 <= len(b):
                size, start, note = struct.unpack_from("<IIH", b, end + 12)
                if end + 22 + note <= len(b):
                    out[end - size - start] = end + 22 + note
        return out

    return ix.owners("zip", find).get(at)


def _ogg(b: bytes, at: int, ix: Index) -> int | None:
    """Pages from one that begins a stream to one that ends it."""

    def step(state: tuple) -> tuple | int | None:
        _, p = state
        if b[p : p + 5] != b"OggS\0" or p + 27 > len(b):
            return None
        table = b[p + 27 : p + 27 + b[p + 26]]
        last, p = b[p + 5] & 4, p + 27 + b[p + 26] + sum(table)
        return None if p > len(b) else p if last else ("ogg", p)

    return ix.follow(("ogg", at), step) if at + 6 <= len(b) and b[at + 5] & 2 else None


# Magic bytes, type, and where the validator starts before them.
MAGIC: list[tuple[bytes, str, Callable[[bytes, int, Index], int | None]]] = [
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"RIFF", "riff", _riff),
    (b"BM", "image/bmp", _bmp),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
    (b"%PDF-", "application/pdf", _pdf),
    (b"PK\3\4", "application/zip", _zip),
    (b"OggS", "audio/ogg", _ogg),
]
RIFF_TYPES = {b"WAVE": "audio/wav", b"AVI ": "video/x-msvideo", b"WEBP": "image/webp"}


class Sniffer:
    """The automaton over all magic bytes; bytes are read as Latin-1 characters, one each."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for magic, kind, check in MAGIC:
            self.automaton.add_word(magic.decode("latin-1"), (len(magic), kind, check))
        self.automaton.make_automaton()

    def find(self, content: bytes) -> list[tuple[str, int, int]]:
        """(type, start, end) of each confirmed object, outermost first: an object inside another that has been confirmed is listed after it."""
        out, ix = [], Index(content)
        for end, (n, kind, check) in self.automaton.iter(content.decode("latin-1")):
            start = end - n + 1
            if (stop := check(content, start, ix)) is not None:
                out.append((RIFF_TYPES.get(content[start + 8 : start + 12], UNKNOWN) if kind == "riff" else kind, start, stop))
        return out

    def inspect(self, content: bytes, declared: str | None) -> tuple[str, bool, list[tuple[str, int, int]]]:
        """The true type, whether the declared one was wrong, and what is embedded."""
        found = self.find(content)
        outer = next((x for x in found if x[1] == 0), None)
        text = UNKNOWN
        if outer is None and content:
            try:
                content.decode()
                text = "text/plain"
            except UnicodeDecodeError:
                pass
        true = outer[0] if outer else text
        return true, declared != true, [x for x in found if x is not outer]


def wav(payload: bytes, rate: int = 8000) -> bytes:
    """An 8-bit mono PCM file of these samples."""
    pad = len(payload) & 1
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload + bytes(pad)


def samples(content: bytes, start: int = 0, stop: int | None = None) -> bytes:
    """The sample bytes of a WAV file."""
    p, stop = start + 12, len(content) if stop is None else stop
    while p + 8 <= stop:
        kind, n = struct.unpack_from("<4sI", content, p)
        if kind == b"data":
            return content[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    raise ValueError("no data chunk")


def padded(raw: bytes, unit: int = 64) -> bytes:
    return raw + bytes(-len(raw) % unit or (0 if raw else unit))


def feature(payload: bytes) -> str:
    """Mean, deviation, extremes, zero crossings about the middle, and entropy of 8-bit samples."""
    x = np.frombuffer(payload, np.uint8)
    share = np.bincount(x, minlength=256)
    share = share[share > 0] / len(x)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"mean={x.mean():.6f};std={x.std():.6f};min={x.min()};max={x.max()};crossings={crossings};entropy={float(-(share * np.log2(share)).sum()):.6f}"


def inspect(df: DataFrame, id_col: str, content_col: str, declared_col: str | None = None) -> DataFrame:
    """(id, declared_type, media_type, corrected, n_bytes, carved): carved holds type, start, length, sha256 and bytes of each embedded object."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(content_col).cast("binary"), F.lit(b"")).alias("content"), (F.col(declared_col).cast("string") if declared_col else F.lit(None).cast("string")).alias("declared_type"))
    kind = dict((f.name, f.dataType.simpleString()) for f in rows.schema)["id"]
    carved = pa.list_(pa.struct([("media_type", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("sha256", pa.string()), ("content", pa.binary())]))

    def make():
        sniffer = Sniffer()

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            contents, declared = b.column("content").to_pylist(), b.column("declared_type").to_pylist()
            seen = [sniffer.inspect(c, d) for c, d in zip(contents, declared, strict=True)]
            parts = [[{"media_type": t, "start": s, "length": e - s, "sha256": hashlib.sha256(c[s:e]).hexdigest(), "content": c[s:e]} for t, s, e in x[2]] for c, x in zip(contents, seen, strict=True)]
            return batch(id=(b.column("id"), None), declared_type=(declared, pa.string()), media_type=([x[0] for x in seen], pa.string()), corrected=([x[1] for x in seen], pa.bool_()), n_bytes=([len(c) for c in contents], pa.int64()), carved=(parts, carved))

        return one

    return map_batches(rows, make, f"id {kind}, declared_type string, media_type string, corrected boolean, n_bytes long, carved array<struct<media_type:string,start:long,length:long,sha256:string,content:binary>>")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text as 8-bit samples in a WAV file that claims to be unknown data, sniffs and carves the stored bytes, and describes what was read back."""

    def make():
        sniffer = Sniffer()

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in b.column("text").to_pylist():
                raw = text.encode()
                stored = wav(padded(raw))
                true, corrected, inner = sniffer.inspect(stored, UNKNOWN)
                if true != "audio/wav":
                    raise ValueError(f"a stored file was read as {true}")
                payload = samples(stored)
                embedded = ",".join(f"{t}@{s}+{e - s}" for t, s, e in inner)
                out.append((len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{feature(payload)};embedded={embedded}", true, corrected))
            names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media_type", "corrected")
            kinds = {str: pa.string(), int: pa.int64(), bool: pa.bool_()}
            return batch(doc_id=(b.column("doc_id"), None), **{n: (list(v), kinds[type(v[0])]) for n, v in zip(names, zip(*out, strict=True), strict=True)})

        return one

    return map_batches(texts(df, id_col, text_col), make, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media_type string, corrected boolean")



def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as samples, read back and described."""
    return round_trip(documents(spark, sf_dir))
