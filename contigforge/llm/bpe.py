"""Byte-level BPE: a segment tree over byte positions holds the leftmost pair of least rank; each merge updates the live neighbours' leaves.

Many pieces are merged side by side: a row of the arrays is a piece, and every step merges one pair in each row that has one left.

Contract of encode() and decode():
- null and empty texts have no tokens; null ids stay null, repeated rows each give a row, an empty table gives none;
- other columns are ignored; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .chunks import BYTE_LEVEL, Chunks
from .common import batch, documents, map_batches, texts, tokenizer_path, worker_state

_NONE = np.int64(1) << 60
_BITS = 28  # of a position; a rank takes the bits above
_CELLS = 1 << 19  # tree cells handled at once


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class SegmentTreeBpe:
    """Merges by rank; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        size = 1 << (max(len(pairs), 1) * 4 - 1).bit_length()
        self.shift, self.mask = np.uint64(64 - (size.bit_length() - 1)), size - 1
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, _NONE, np.int64)
        keys, values = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        self.probes = 0
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):  # linear probing, all keys at once: of those that want a free slot, one gets it
            self.probes += 1
            free = left[self.keys[slot[left]] == -1]
            took, which = np.unique(slot[free], return_index=True)
            self.keys[took], self.values[took] = keys[free[which]], values[free[which]]
            left = np.setdiff1d(left, free[which], assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, or none."""
        keys = a << 32 | b
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], _NONE)
        left = np.flatnonzero((there != keys) & (there != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            there = self.keys[slot[left]]
            hit = left[there == keys[left]]
            out[hit] = self.values[slot[hit]]
            left = left[(there != keys[left]) & (there != -1)]
        return out

    def _merge(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """The ids of pieces of at most width bytes, a power of two."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        spread = np.zeros((n, width), np.uint8)
        spread[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.byte[spread]
        ids[np.arange(width) >= size[:, None]] = -1
        follow, before = np.tile(np.arange(1, width + 1), (n, 1)), np.tile(np.arange(-1, width - 1), (n, 1))
        tree = np.full((n, 2 * width), _NONE, np.int64)
        if width > 1:
            row, at = np.nonzero(ids[:, 1:] >= 0)
            rank = self.rank(ids[row, at], ids[row, at + 1])
            tree[row, width + at] = np.where(rank < _NONE, rank << _BITS | at, _NONE)
            level = width
            while level > 1:
                tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
                level //= 2
        flat, base = tree.reshape(-1), np.arange(n) * 2 * width
        fid, ffollow, fbefore, fbase = ids.reshape(-1), follow.reshape(-1), before.reshape(-1), np.arange(n) * width

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            cell, own = width + at, base[rows]
            flat[own + cell] = value
            while (cell := cell >> 1)[0]:
                flat[own + cell] = np.minimum(flat[own + 2 * cell], flat[own + 2 * cell + 1])

        def key(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
            rank = self.rank(fid[fbase[rows] + a], fid[fbase[rows] + b])
            return np.where(rank < _NONE, rank << _BITS | a, _NONE)

        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            top = flat[base[live] + 1]
            at, own = top & ((1 << _BITS) - 1), fbase[live]
            gone = ffollow[own + at]
            after = ffollow[own + gone]
            fid[own + at] = top >> _BITS
            fid[own + gone] = -1
            ffollow[own + at] = after
            inner = after < size[live]
            fbefore[(own + after)[inner]] = at[inner]
            put(live, gone, np.full(len(live), _NONE))
            value = np.full(len(live), _NONE)
            value[inner] = key(live[inner], at[inner], after[inner])
            put(live, at, value)
            prior = fbefore[own + at]
            if len(some := np.flatnonzero(prior >= 0)):
                put(live[some], prior[some], key(live[some], prior[some], at[some]))
            live = live[flat[base[live] + 1] < _NONE]
        return np.split(ids[ids >= 0], np.cumsum((ids >= 0).sum(1))[:-1])

    def pieces(self, pieces: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit bytes."""
        out, sized = {}, {}
        for p in set(pieces):
            if (r := self.ranks.get(p)) is not None:
                out[p] = r.to_bytes(4, "little")
            else:
                sized.setdefault(1 << max(len(p) - 1, 0).bit_length(), []).append(p)
        for width, some in sized.items():
            step = max(1, _CELLS // width)
            for i in range(0, len(some), step):
                for p, ids in zip(some[i : i + step], self._merge(some[i : i + step], width), strict=True):
                    out[p] = ids.astype("<u4").tobytes()
        return out


class ByteBpe:
    """Encoder and decoder over a rank file and the pattern that splits a text into pieces."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        self.bpe = SegmentTreeBpe(read_ranks(path))
        self.chunks, self.next = Chunks(self.whole, BYTE_LEVEL, lambda p: self.next[p], self.prepare), {}

    def prepare(self, strings: list[str]) -> None:
        """Merges, side by side, the pieces of a batch that are not remembered."""
        new = list({p for s in set(strings) for p in BYTE_LEVEL(s) if p not in self.chunks.pieces})
        ids = self.bpe.pieces(raw := [p.encode() for p in new])
        self.next = dict(zip(new, map(ids.__getitem__, raw), strict=True))

    def whole(self, strings: list[str]) -> list[bytes]:
        split = [self.split(s) for s in strings]
        ids = self.bpe.pieces(p.encode() for s in split for p in s)
        return [b"".join(ids[p.encode()] for p in s) for s in split]

    def clear(self) -> None:
        self.chunks.clear()
        self.next = {}

    def encode(self, strings: list[str]) -> list[bytes]:
        return self.chunks.encode(strings)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bpe.token.__getitem__, ids))


def coder(path: str, pattern: str) -> ByteBpe:
    """One for each worker."""
    return worker_state(("bpe", path, pattern), lambda: ByteBpe(path, pattern))


def public_coder(folder: str | None = None) -> tuple[str, str]:
    import public_tokenizers

    return tokenizer_path("byte_bpe_50k.tiktoken", folder), public_tokenizers.PATTERN


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every text."""

    def make():
        own = coder(*public_coder(folder))

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = own.encode(b.column("text").to_pylist())
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)])
            return batch(doc_id=(b.column("doc_id"), None), ids=(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))), None))

        return one

    return map_batches(texts(df, id_col, text_col), make, "doc_id long, ids array<int>")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", folder: str | None = None) -> DataFrame:
    """(doc_id, content binary) of every list of ids; an id that is not in the vocabulary fails."""

    def make():
        own = coder(*public_coder(folder))
        return lambda b: batch(doc_id=(b.column("doc_id"), None), content=([own.decode(x or []) for x in b.column("ids").to_pylist()], pa.binary()))

    return map_batches(df.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{ids_col}` as array<int>) ids"), make, "doc_id long, content binary")


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Each text encoded and decoded again: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def make():
        own = coder(*public_coder(folder))
        decimal = {r: str(r).encode() for r in own.bpe.token}

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_sha, text_sha = [], [], []
            for x in own.encode(b.column("text").to_pylist()):
                ids = np.frombuffer(x, "<u4").tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            return batch(doc_id=(b.column("doc_id"), None), n_tokens=(n, pa.int64()), ids_sha256=(ids_sha, pa.string()), decoded_sha256=(text_sha, pa.string()))

        return one

    return map_batches(texts(df, id_col, text_col), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the public ranks and decoded again."""
    return digest(documents(spark, sf_dir))
