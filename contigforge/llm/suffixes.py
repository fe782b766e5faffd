"""Repeated passages by merged Burrows-Wheeler transforms of shards.

Each shard's suffixes are sorted once. Transforms are then merged by refining their interleaving: in round h, every row steps to the suffix
one byte longer to the left, stably ordered by that byte, so that the interleaving is right for the first h bytes. Rows that are apart stay
apart at the same place, so the number of rounds in which neighbours are not apart is their common prefix. Where that is LENGTH are the
repeated intervals: equal strings of LENGTH bytes. No suffix is sorted again.

What comes to the merge is chosen before. A window (string of LENGTH bytes) has an anchor, the gram of GRAM bytes with the least hash in
it, leftmost on ties; equal windows have equal anchors. Consecutive windows with one anchor form a run. Runs of equal hashes (112 bits) count as
equal and are decided by the least id of them; only runs whose anchor also occurs in another run are sent on to be merged.

Documents are dealt to chunks by a hash of id and text; a chunk sends each different run of its own once. So a passage that many documents share
costs one row for each chunk, and no group grows with the number of documents. Anchors with over HOT different runs, as at the edges of such a
passage, are sent as single windows dealt by their own hash, each once for each chunk. Chunks, buckets and partitions grow in number with the bytes.

Contract of remove_repeats():
- null and empty texts, and texts under LENGTH bytes, lose nothing; a null id counts as larger than all ids and stays null;
- rows of equal id never take bytes from each other; an empty table gives an empty one; texts of any length are handled in pieces;
- other columns come back unchanged, but for the text.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .common import column, documents, shuffle_partitions, worker_state

LENGTH = 50
GRAM = 20
#: Different runs of one anchor beyond which its windows are dealt one by one.
HOT = 20_000
#: Documents in a chunk, and bytes of text, on average at most.
CHUNK_DOCUMENTS, CHUNK_BYTES = 2048, 8 << 20
#: Bytes of text in one shuffle partition, on average at most.
PART_BYTES = 8 << 20
#: Windows of a text hashed at once, and bytes of a batch of them.
PIECE, BATCH = 1 << 17, 1 << 18
#: Strings of a shard whose suffixes are sorted at once.
SHARD = 4096
_LAST = 2**63 - 1

_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out


_UP, _DOWN = _powers(_BASE, BATCH + PIECE + 4 * LENGTH), _powers(pow(_BASE, -1, 1 << 64), BATCH + PIECE + 4 * LENGTH)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class Runs:
    """The runs of a chunk's texts: doc (its place in the chunk), first (window), windows, anchor (48 bits) and context (64 bits) of each."""

    def __init__(self, raws: list[bytes]):
        self.raws = raws
        found, held, size = [], [], 0
        for d, raw in enumerate(raws):
            for at in range(0, max(len(raw) - LENGTH + 1, 0), PIECE):
                held.append((d, at, raw[at : at + PIECE + LENGTH - 1]))
                size += len(held[-1][2])
                if size >= BATCH:
                    found.append(self._of(held))
                    held, size = [], 0
        if held:
            found.append(self._of(held))
        empty = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
        self.doc, self.first, self.windows, self.anchor, self.context = (np.concatenate(x) for x in zip(*found, strict=True)) if found else empty

    @staticmethod
    def _of(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _UP[:n], out=sums[1:])
        gram = (sums[GRAM:] - sums[:-GRAM]) * _DOWN[: n - GRAM + 1]
        order = (_mix(gram, 1) >> np.uint64(28) << np.uint64(28)) | np.arange(len(gram), dtype=np.uint64)
        width, have = LENGTH - GRAM + 1, 1
        while 2 * have <= width:
            order = np.minimum(order[:-have], order[have:])
            have *= 2
        order = np.minimum(order[: n - LENGTH + 1], order[width - have :][: n - LENGTH + 1])
        at = (order & np.uint64((1 << 28) - 1)).astype(np.int64)  # of each window's anchor
        sizes = np.array([len(p[2]) for p in pieces])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        cut = np.empty(len(at), bool)
        cut[:1] = True
        np.not_equal(at[1:], at[:-1], out=cut[1:])
        cut[begins] = True
        for k in ends[:-1] - LENGTH + 1:  # windows that reach over the end of a piece
            cut[k : k + LENGTH - 1] = False
            cut[k] = True
        start = np.flatnonzero(cut)
        piece = np.searchsorted(ends, start, "right")
        stop = np.minimum(np.append(start[1:], len(at)), ends[piece] - LENGTH + 1)
        real = stop > start
        start, stop, piece = start[real], stop[real], piece[real]
        anchor = _mix(gram[at[start]], 2) >> np.uint64(16)
        whole = (sums[stop + LENGTH - 1] - sums[start]) * _DOWN[start]
        context = _mix(whole + (at[start] - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019) + (stop - start).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7), 3)
        doc, base = np.array([p[0] for p in pieces])[piece], np.array([p[1] for p in pieces])[piece]
        return doc, base + start - begins[piece], stop - start, anchor, context

    def different(self, ids: np.ndarray, buckets: int) -> None:
        """The different runs, by bucket, anchor and context: row of each run (name), and for each row bucket, place in it, least id and one run that is it (sample)."""
        order = np.lexsort((self.context, self.anchor, self.anchor % np.uint64(buckets)))
        a, c = self.anchor[order], self.context[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        self.name = np.empty(len(a), np.int64)
        self.name[order] = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        self.sample = order[firsts]
        self.least = np.minimum.reduceat(ids[self.doc[order]], firsts) if len(firsts) else np.zeros(0, np.int64)
        self.row_bucket = (a[firsts] % np.uint64(buckets)).astype(np.int64)
        self.bounds = np.searchsorted(self.row_bucket, np.arange(buckets + 1))

    def bytes_of(self, run: int) -> bytes:
        d, f = int(self.doc[run]), int(self.first[run])
        return self.raws[d][f : f + int(self.windows[run]) + LENGTH - 1]

    def single(self, names: np.ndarray, ids: np.ndarray, buckets: int):
        """The different windows of the runs with these names: the runs' windows (run, offset), which of the different ones each is, and of those bytes, least id, bucket and place in it."""
        wanted = np.zeros(len(self.least), bool)
        wanted[names] = True
        runs = np.flatnonzero(wanted[self.name])
        run = np.repeat(runs, self.windows[runs])
        offset = np.arange(len(run)) - np.repeat(np.cumsum(self.windows[runs]) - self.windows[runs], self.windows[runs])
        found: dict[bytes, int] = {}
        which = np.array([found.setdefault(self.raws[d][f : f + LENGTH], len(found)) for d, f in zip(self.doc[run].tolist(), (self.first[run] + offset).tolist(), strict=True)], np.int64)
        content = list(found)
        least = np.full(len(content), _LAST)
        np.minimum.at(least, which, ids[self.doc[run]])
        bucket = np.array([int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little") % buckets for x in content], np.int64)
        order = sorted(range(len(content)), key=lambda i: (bucket[i], content[i]))
        rank = np.empty(len(content), np.int64)
        rank[order] = np.arange(len(content))
        bucket, least, content = bucket[order], least[order], [content[i] for i in order]
        return run, offset, rank[which], content, least, bucket, np.searchsorted(bucket, np.arange(buckets + 1))


class ShardTransform:
    """Sorted suffixes of some strings, each string ended by a mark of its own that sorts first."""

    def __init__(self, strings: list[bytes]):
        n, width = len(strings), max(map(len, strings)) + 1
        size = np.fromiter(map(len, strings), np.int64, n)
        grid = np.zeros((n, width + 112), np.uint64)
        inside = np.arange(width) < size[:, None]
        grid[:, :width][inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint64) + np.uint64(1)
        rank = np.zeros_like(grid)
        for k in range(7):
            rank[:, :width] = rank[:, :width] << np.uint64(9) | grid[:, k : k + width]
        real = np.arange(width) <= size[:, None]  # with the end mark
        depth = 7
        flat = np.unique(rank[:, :width][real], return_inverse=True)[1]
        while depth < width:
            rank[:] = 0
            rank[:, :width][real] = flat.astype(np.uint64) + np.uint64(1)
            after = np.zeros((n, width), np.uint64)
            if depth < width:
                after[:, : width - depth] = rank[:, depth:width]
            flat = np.unique((rank[:, :width] << np.uint64(32) | after)[real], return_inverse=True)[1]
            depth *= 2
        order = np.argsort(flat, kind="stable")
        string, place = np.nonzero(real)
        self.string, self.place = string[order], place[order]
        row = np.empty((n, width), np.int64)
        row[self.string, self.place] = np.arange(len(order))
        self.left = np.where(self.place > 0, row[self.string, np.maximum(self.place - 1, 0)], -1)  # the row of the suffix one byte longer
        self.symbol = np.where(self.place > 0, grid[self.string, np.maximum(self.place - 1, 0)], 0).astype(np.uint16)
        self.ends = row[np.arange(n), size]
        self.size = size


def merge(shards: list[ShardTransform], length: int = LENGTH):
    """(shard, string, place, common): all suffixes in the order of their first length bytes, and the common prefix of each with the one before, up to length, at most 255.

    End marks are told apart from each other, so a suffix shorter than length has no more in common than its bytes.
    """
    bases = np.cumsum([0, *(len(s.left) for s in shards)])
    symbol = np.concatenate([s.symbol for s in shards])
    left = np.concatenate([np.where(s.left >= 0, s.left + b, -1) for s, b in zip(shards, bases, strict=False)])
    ends = np.concatenate([s.ends + b for s, b in zip(shards, bases, strict=False)])
    used = np.unique(symbol)
    if len(used) <= 256:
        symbol = np.searchsorted(used, symbol).astype(np.uint8) + np.uint8(used[0] != 0 and len(used) < 256)
        symbol = symbol if used[0] == 0 or len(used) < 256 else np.searchsorted(used, symbol).astype(np.uint16) + 1
    now = np.arange(len(left))  # rows, shard after shard: the first interleaving
    block = np.zeros(len(left), np.int64)
    common = np.zeros(len(left), np.uint8)
    for _ in range(length):
        s = symbol[now]
        some = np.flatnonzero(s)
        some = some[np.argsort(s[some], kind="stable")]
        letters, old = s[some], block[some]
        now = np.concatenate([ends, left[now[some]]])
        apart = np.ones(len(now), bool)
        if len(some):
            apart[len(ends) + 1 :] = (letters[1:] != letters[:-1]) | (old[1:] != old[:-1])
        block = np.cumsum(apart)
        common += ~apart
    shard = np.searchsorted(bases, now, "right") - 1
    row = now - bases[shard]
    string, place = np.empty(len(now), np.int64), np.empty(len(now), np.int64)
    for k, s in enumerate(shards):
        own = shard == k
        string[own], place[own] = s.string[row[own]], s.place[row[own]]
    return shard, string, place, common


def least_ids(strings: list[bytes], ids: np.ndarray, length: int = LENGTH, size: int = SHARD) -> list[np.ndarray]:
    """For each window of each string the least id among all strings that have it; strings are different and at least length long."""
    step = max(1, min(size, -(-len(strings) // 2)))
    shards = [ShardTransform(strings[i : i + step]) for i in range(0, len(strings), step)]
    shard, string, place, common = merge(shards, length)
    string = string + shard * step
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.flatnonzero(common < length)  # of the repeated intervals, and of what does not repeat
    least = np.repeat(np.minimum.reduceat(ids[string], starts), np.diff(np.append(starts, len(string))))
    windows = place + length <= sizes[string]
    out = [np.empty(n - length + 1, np.int64) for n in sizes.tolist()]
    begin = np.cumsum(sizes - length + 1) - (sizes - length + 1)
    flat = np.empty(int((sizes - length + 1).sum()), np.int64)
    flat[begin[string[windows]] + place[windows]] = least[windows]
    return np.split(flat, begin[1:]) if len(out) else out


# What is sent between chunks and buckets: (chunk, bucket, kind, content). Columns of numbers lie one after another, so that they compress.
SENT = "chunk long, bucket long, kind int, content binary"
RUNS, FOUND, PART, LEAST, SINGLE, SINGLE_LEAST = range(6)


def _pack(*columns: np.ndarray) -> bytes:
    return struct.pack("<I", len(columns[0])) + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def _unpack(content: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = struct.unpack_from("<I", content)[0], 4, []
    for k in kinds:
        out.append(np.frombuffer(content, k, n, at))
        at += out[-1].nbytes
    return [*out, content[at:]]


def _table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["chunk", "bucket", "kind", "content"])


class Chunk:
    """A chunk's texts with ids, the runs in them and what buckets said of them."""

    def __init__(self, table: pa.Table, buckets: int):
        worker_state("repeats", object)
        self.raws = [x if isinstance(x, bytes) else (x or "").encode() for x in table.column("_raw").to_pylist()]
        self.ids = np.array([_LAST if x is None else x for x in table.column("_id").to_pylist()], np.int64)
        self.buckets = buckets

    def find(self) -> None:
        self.runs = Runs(self.raws)
        self.runs.different(self.ids, self.buckets)

    def hear(self, found: list[tuple[int, bytes]]) -> None:
        """Takes what the first buckets found: least ids of equal runs, and which runs have others beside them."""
        self.least, self.state = self.runs.least.copy(), np.zeros(len(self.runs.least), np.uint8)
        for bucket, content in found:
            place, state, least, _ = _unpack(content, "<u4", "u1", "<i8")
            row = self.runs.bounds[bucket] + place
            self.least[row], self.state[row] = np.minimum(self.least[row], least), state


def _first(buckets: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        c = Chunk(table, buckets)
        c.find()
        r = c.runs
        anchor, context, out = r.anchor[r.sample], r.context[r.sample], []
        for b in np.flatnonzero(np.diff(r.bounds)).tolist():
            s = slice(r.bounds[b], r.bounds[b + 1])
            a, x, i = anchor[s], context[s], r.least[s]
            out.append((key[0].as_py(), b, RUNS, _pack(a.astype("<u4"), (a >> np.uint64(32)).astype("<u2"), x.astype("<u4"), (x >> np.uint64(32)).astype("<u4"), i.astype("<u4"), (i >> 32).astype("<i4"))))
        return _table(out)

    return send


def _compare(hot: int):
    def answer(_key: tuple, table: pa.Table) -> pa.Table:
        """Of one bucket: which anchors have several different runs, and the least id of each run."""
        bucket = table.column("bucket")[0].as_py()
        chunks, columns = table.column("chunk").to_pylist(), [_unpack(x, "<u4", "<u2", "<u4", "<u4", "<u4", "<i4") for x in table.column("content").to_pylist()]
        counts = [len(c[0]) for c in columns]
        a0, a1, x0, x1, i0, i1 = (np.concatenate([c[k] for c in columns]).astype(np.int64) for k in range(6))
        anchor, context, ids = a1 << 32 | a0, x1 << 32 | x0, i1 << 32 | i0
        order = np.lexsort((context, anchor))
        a, c = anchor[order], context[order]
        new_a, new = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[1:] != a[:-1]
        new[1:] = new_a[1:] | (c[1:] != c[:-1])
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        several = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_a))[np.cumsum(new_a) - 1]
        tell = np.flatnonzero((several > 1) | (least < ids[order]))
        source = order[tell]
        state, least = np.where(several[tell] > hot, 2, several[tell] > 1).astype("u1"), least[tell]
        back = np.argsort(source, kind="stable")
        source, state, least = source[back], state[back], least[back]
        ends = np.cumsum(counts)
        bounds, out = np.searchsorted(source, np.concatenate([[0], ends])), []
        for k, chunk in enumerate(chunks):
            s = slice(bounds[k], bounds[k + 1])
            if s.stop > s.start:
                out.append((chunk, bucket, FOUND, _pack((source[s] - (ends[k] - counts[k])).astype("<u4"), state[s], least[s].astype("<i8"))))
        return _table(out)

    return answer


def _second(buckets: int):
    def send(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        """The bytes of runs that have others beside them, and single windows of those with very many."""
        found = list(zip(said.column("bucket").to_pylist(), said.column("content").to_pylist(), strict=True)) if said.num_rows else []
        if not table.num_rows or not any(_unpack(x, "<u4", "u1", "<i8")[1].any() for _, x in found):
            return _table([])
        c, out, chunk = Chunk(table, buckets), [], key[0].as_py()
        c.find()
        c.hear(found)
        r = c.runs
        rows = np.flatnonzero(c.state == 1)
        bounds = np.searchsorted(r.row_bucket[rows], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            own = rows[bounds[b] : bounds[b + 1]]
            parts = [r.bytes_of(x) for x in r.sample[own].tolist()]
            out.append((chunk, b, PART, _pack((own - r.bounds[b]).astype("<u4"), np.array(list(map(len, parts)), "u1"), c.least[own].astype("<i8")) + b"".join(parts)))
        if len(rows := np.flatnonzero(c.state == 2)):
            *_, content, least, _, bounds = r.single(rows, c.ids, buckets)
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                s = slice(bounds[b], bounds[b + 1])
                n = int(s.stop - s.start)
                out.append((chunk, b, SINGLE, _pack(np.arange(n, dtype="<u4"), np.full(n, LENGTH, "u1"), least[s].astype("<i8")) + b"".join(content[s])))
        return _table(out)

    return send


def repeated_windows(strings: list[bytes]) -> np.ndarray:
    """Of all windows of all strings, in order, whether its hash comes again: one that doesn't is no repeat."""
    found, held, size = [], [], 0

    def close() -> None:
        data = np.frombuffer(b"".join(held), np.uint8)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _UP[: len(data)], out=sums[1:])
        value = _mix((sums[LENGTH:] - sums[:-LENGTH]) * _DOWN[: len(data) - LENGTH + 1], 4)
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        inside = np.ones(len(data), bool)
        ends = np.cumsum(sizes)
        for k in range(1, LENGTH):
            inside[ends - k] = False
        found.append(value[inside[: len(value)]])

    for x in strings:
        held.append(x)
        size += len(x)
        if size >= BATCH:
            close()
            held, size = [], 0
    if held:
        close()
    value = np.concatenate(found)
    order = np.argsort(value)
    same = value[order][1:] == value[order][:-1]
    out = np.zeros(len(value), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _merge_bucket(_key: tuple, table: pa.Table) -> pa.Table:
    """Merges the shards of one bucket and tells each chunk the windows that a smaller id has.

    Only stretches of windows whose hash comes again are merged, equal stretches once.
    """
    bucket = table.column("bucket")[0].as_py()
    names: dict[bytes, int] = {}
    least: list[int] = []
    rows = []
    for chunk, kind, content in zip(*(table.column(k).to_pylist() for k in ("chunk", "kind", "content")), strict=True):
        place, size, ids, text = _unpack(content, "<u4", "u1", "<i8")
        ends = np.cumsum(size, dtype=np.int64).tolist()
        which = []
        for s, e, i in zip([0, *ends], ends, ids.tolist(), strict=False):
            w = names.setdefault(text[s:e], len(names))
            which.append(w)
            if w == len(least):
                least.append(i)
            elif i < least[w]:
                least[w] = i
        rows.append((chunk, kind, place, ids, which))
    strings = list(names)
    again = repeated_windows(strings)
    counts = np.fromiter(map(len, strings), np.int64, len(strings)) - LENGTH + 1
    ends = np.cumsum(counts)
    flat = np.repeat(np.array(least, np.int64), counts)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]  # stretches, cut where a string ends
    inner = ends[:-1][(np.searchsorted(start, ends[:-1], "left") - 1 >= 0) & again[np.maximum(ends[:-1] - 1, 0)] & again[ends[:-1]]] if len(ends) > 1 else ends[:0]
    start, stop = np.sort(np.concatenate([start, inner])), np.sort(np.concatenate([stop, inner]))
    owner = np.searchsorted(ends, start, "right")
    parts: dict[bytes, int] = {}
    part_least: list[int] = []
    part_of = []
    for w, f, t in zip(owner.tolist(), (start - (ends - counts)[owner]).tolist(), (stop - (ends - counts)[owner]).tolist(), strict=True):
        k = parts.setdefault(strings[w][f : t + LENGTH - 1], len(parts))
        part_of.append(k)
        if k == len(part_least):
            part_least.append(least[w])
        elif least[w] < part_least[k]:
            part_least[k] = least[w]
    if parts:
        found = least_ids(list(parts), np.array(part_least, np.int64))
        for k, s, e in zip(part_of, start.tolist(), stop.tolist(), strict=True):
            flat[s:e] = found[k]
    out = []
    begins = ends - counts
    for chunk, kind, place, ids, which in rows:
        which = np.array(which, np.int64)
        n = counts[which]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        value = flat[np.repeat(begins[which], n) + k]
        tell = np.flatnonzero(value < np.repeat(ids, n))
        if len(tell):
            out.append((chunk, bucket, LEAST if kind == PART else SINGLE_LEAST, _pack(np.repeat(place, n)[tell].astype("<u4"), k[tell].astype("u1"), value[tell].astype("<i8"))))
    return _table(out)


def _spans(c: Chunk, said: pa.Table) -> list[np.ndarray]:
    """The removed spans of each text of a chunk: rows of (start, end), apart from each other."""
    c.find()
    r = c.runs
    told = list(zip(*(said.column(k).to_pylist() for k in ("bucket", "kind", "content")), strict=True)) if said.num_rows else []
    c.hear([(b, x) for b, k, x in told if k == FOUND])
    own = c.ids[r.doc]
    whole = c.least[r.name] < own
    doc, start, end = [r.doc[whole]], [r.first[whole]], [(r.first + r.windows + LENGTH - 1)[whole]]
    by_name = np.argsort(r.name, kind="stable")
    first_of = np.searchsorted(r.name[by_name], np.arange(len(r.least) + 1))

    def windows(run: np.ndarray, offset: np.ndarray, least: np.ndarray) -> None:
        keep = least < own[run]
        doc.append(r.doc[run[keep]])
        start.append(r.first[run[keep]] + offset[keep])
        end.append(start[-1] + LENGTH)

    for b, k, x in told:
        if k == LEAST:
            place, offset, least, _ = _unpack(x, "<u4", "u1", "<i8")
            row = r.bounds[b] + place
            count = first_of[row + 1] - first_of[row]
            at = np.repeat(first_of[row] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            windows(by_name[at], np.repeat(offset.astype(np.int64), count), np.repeat(least, count))
    if len(rows := np.flatnonzero(c.state == 2)):
        run, offset, which, _, least, _, bounds = r.single(rows, c.ids, c.buckets)
        for b, k, x in told:
            if k == SINGLE_LEAST:
                place, _, less, _ = _unpack(x, "<u4", "u1", "<i8")
                least[bounds[b] + place] = np.minimum(least[bounds[b] + place], less)
        windows(run, offset, least[which])
    doc, start, end = np.concatenate(doc), np.concatenate(start), np.concatenate(end)
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    out = []
    for s, e in zip(b0 := np.searchsorted(doc, np.arange(len(c.raws) + 1))[:-1], np.append(b0[1:], len(doc)), strict=True):
        if s == e:
            out.append(np.zeros((0, 2), np.int64))
            continue
        reach = np.maximum.accumulate(end[s:e])
        new = np.ones(e - s, bool)
        new[1:] = start[s + 1 : e] > reach[:-1]
        first = np.flatnonzero(new)
        out.append(np.stack([start[s:e][first], reach[np.append(first[1:], e - s) - 1]], 1))
    return out


def _kept(raw: bytes, spans: np.ndarray) -> bytes:
    at, out = 0, []
    for s, e in spans.tolist():
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]])


def _plan(rows: DataFrame, finish, schema: str, hot: int) -> DataFrame:
    """The whole plan in one query: rows (_id, _raw and others) are dealt to chunks by one exchange that all three steps over them reuse."""
    spark = rows.sparkSession
    ship(spark)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("_raw")), F.lit(0)).alias("bytes")).first()
    chunks = max(1, size.n // CHUNK_DOCUMENTS, size.bytes // CHUNK_BYTES)
    parts = max(shuffle_partitions(spark), size.bytes // PART_BYTES)
    buckets = 2 * parts
    by_chunk = rows.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_raw"), F.lit(chunks))).repartition(parts, "_chunk").groupBy("_chunk")
    first = by_chunk.applyInArrow(_first(buckets), SENT)
    found = first.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_compare(hot), SENT)
    second = by_chunk.cogroup(found.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(_second(buckets), SENT)
    merged = second.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_merge_bucket, SENT)
    return by_chunk.cogroup(found.unionByName(merged).repartition(parts, "chunk").groupBy("chunk")).applyInArrow(finish(buckets), schema)


def _own(df: DataFrame, id_col: str, text_col: str) -> list:
    return [column(id_col).cast("long").alias("_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("_raw")]


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """DIGEST of every text: removed bytes and spans, and a hash of what is left."""

    def finish(buckets: int):
        def end(_key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
            c = Chunk(table, buckets)
            spans = _spans(c, said)
            columns = [table.column("_id").combine_chunks(), pa.array(list(map(len, c.raws)), pa.int64()), pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64()), pa.array(list(map(len, spans)), pa.int64()), pa.array([hashlib.sha256(_kept(r, s)).hexdigest() for r, s in zip(c.raws, spans, strict=True)], pa.string())]
            return pa.table(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return end

    return _plan(df.select(*_own(df, id_col, text_col)), finish, DIGEST, hot)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """df with repeated passages cut from its texts; a character of which bytes are left over at a cut goes too. A null text stays null."""
    others = [c for c in df.columns if c != text_col]
    held = [f"_c{i}" for i in range(len(others))]

    def finish(buckets: int):
        def end(_key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
            c = Chunk(table, buckets)
            text = [_kept(r, s).decode("utf-8", "ignore") for r, s in zip(c.raws, _spans(c, said), strict=True)]
            missing = table.column("_null").to_pylist()
            return pa.table([*(table.column(k) for k in held), pa.array([None if m else t for t, m in zip(text, missing, strict=True)], pa.string())], names=[*held, "_text"])

        return end

    rows = df.select(*_own(df, id_col, text_col), column(text_col).isNull().alias("_null"), *[column(c).alias(h) for c, h in zip(others, held, strict=True)])
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*held).schema), "_text string"])
    names = dict(zip(others, held, strict=True)) | {text_col: "_text"}
    return _plan(rows, finish, schema, hot).select(*[F.col(names[c]).alias(c) for c in df.columns])


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses of passages that a document of smaller id has."""
    return digest(documents(spark, sf_dir))
