"""Token-id files: patched frame-of-reference blocks with an index of block starts.

A shard holds a range of documents in ascending id order. Its payload is a sequence of blocks of BLOCK ids. A block stores its least id,
the differences from it packed at the width that PERCENTILE of them need, and the positions and high bits of the rest as exceptions.

Contract of write() and read():
- a null or empty text has only the end id; a null document id sorts first and stays null;
- repeated rows are kept, each with its own ids, ties in the order of their texts;
- an empty table gives no shard and no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import BLOCK_BYTES, library
from .common import documents, map_batches, shared_dir, texts, tokenizer_path, worker_state

BLOCK = 128
#: Share of a block's differences that its packed width holds.
PERCENTILE = 0.9
#: Ids in one segment of a shard, at most a document more; a segment is encoded and decoded at once.
SEGMENT_IDS = 1 << 18
_HEAD = struct.Struct("<4sQI")


def encode_blocks(ids: np.ndarray) -> bytes:
    """Head, least ids, widths, exception counts, block starts, exception positions, exception high bits, packed differences."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.uint32)
    grid.reshape(-1)[:n] = ids
    if n % BLOCK:
        grid[-1, n % BLOCK :] = grid[-1, 0]
    least = grid.min(1) if blocks else np.zeros(0, np.uint32)
    rest = grid - least[:, None]
    need = np.frexp(rest.astype(np.float64))[1].astype(np.uint8)  # bits of each difference
    width = np.sort(need, 1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1] if blocks else np.zeros(0, np.uint8)
    over = need > width[:, None]
    row, place = np.nonzero(over)
    high = (rest[row, place].astype(np.uint64) >> width[row].astype(np.uint64)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(width.astype(np.int64) * (BLOCK // 8))])
    packed = np.zeros(starts[-1], np.uint8)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            bits = (rest[own][:, :, None] >> np.arange(w, dtype=np.uint32) & 1).astype(np.uint8)
            packed[starts[own][:, None] + np.arange(int(w) * BLOCK // 8)] = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
    return b"".join([_HEAD.pack(b"PFR1", n, blocks), least.tobytes(), width.tobytes(), over.sum(1).astype(np.uint8).tobytes(), starts.astype("<u8").tobytes(), place.astype(np.uint8).tobytes(), high.astype("<u4").tobytes(), packed.tobytes()])


class Blocks:
    """Reader of one encoded segment; block(i) is reached by the index, without the blocks before it."""

    def __init__(self, raw: bytes):
        magic, self.n, self.blocks = _HEAD.unpack_from(raw)
        if magic != b"PFR1":
            raise ValueError("not a token segment")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.least, self.width, self.extra, self.starts = take("<u4", self.blocks), take("u1", self.blocks), take("u1", self.blocks), take("<u8", self.blocks + 1).astype(np.int64)
        self.extras = np.concatenate([[0], np.cumsum(self.extra, dtype=np.int64)])
        self.place, self.high = take("u1", int(self.extras[-1])), take("<u4", int(self.extras[-1]))
        self.packed = take("u1", int(self.starts[-1]))

    def _some(self, own: np.ndarray) -> np.ndarray:
        out = np.zeros((len(own), BLOCK), np.uint32)
        for w in np.unique(self.width[own]):
            if w:
                at = np.flatnonzero(self.width[own] == w)
                bits = np.unpackbits(self.packed[self.starts[own[at]][:, None] + np.arange(int(w) * BLOCK // 8)], axis=1, bitorder="little").reshape(len(at), BLOCK, int(w))
                value = np.zeros((len(at), BLOCK), np.uint32)
                for k in range(int(w)):
                    value |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
                out[at] = value
        count = self.extra[own].astype(np.int64)
        row = np.repeat(np.arange(len(own)), count)
        which = np.repeat(self.extras[own] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        out[row, self.place[which]] |= (self.high[which].astype(np.uint64) << self.width[own][row].astype(np.uint64)).astype(np.uint32)
        return out + self.least[own][:, None]

    def block(self, i: int) -> np.ndarray:
        return self._some(np.array([i]))[0][: min(BLOCK, self.n - i * BLOCK)]

    def all(self) -> np.ndarray:
        return self._some(np.arange(self.blocks)).reshape(-1)[: self.n]


FILES = "shard int, segment int, shard_start long, doc_ids array<long>, n_tokens array<long>, payload binary"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """The ids and texts of as many batches as hold BLOCK_BYTES."""
    doc_ids, rows, size = [], [], 0
    for b in batches:
        doc_ids += b.column("doc_id").to_pylist()
        rows += b.column("text").to_pylist()
        size += b.nbytes
        if size >= BLOCK_BYTES:
            yield doc_ids, rows
            doc_ids, rows, size = [], [], 0
    yield doc_ids, rows


def write(df: DataFrame, path: str, vocabulary: str, end_id: int, words: bool = True, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the shards of FILES under path: documents in ascending id order over all shards, each with the end id after its own ids."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        shard, segment, before, held_ids, held_n, held, size = TaskContext.get().partitionId(), 0, 0, [], [], [], 0

        def out():
            columns = [[shard], [segment], [before], [held_ids], [held_n], [encode_blocks(np.frombuffer(b"".join(held), "<u4"))]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "segment", "shard_start", "doc_ids", "n_tokens", "payload"])

        encoder = library(vocabulary, words)
        for doc_ids, rows in _gathered(batches):
            for doc_id, ids in zip(doc_ids, encoder.encode(rows), strict=True):
                held_ids.append(doc_id)
                held.append(ids + end)
                held_n.append(len(ids) // 4 + 1)
                size += held_n[-1]
                if size >= SEGMENT_IDS:
                    yield out()
                    segment, before, held_ids, held_n, held, size = segment + 1, before + size, [], [], [], 0
        if held:
            yield out()

    rows = texts(df, id_col, text_col)
    rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, FILES).write.parquet(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """The segments under path, each with the number of ids before it in all shards."""
    f = spark.read.schema(FILES).parquet(path)
    shards = f.groupBy("shard").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))  # a row for each task that wrote: at most the session's shuffle partitions
    bases = shards.select("shard", (F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("base"))
    return f.join(F.broadcast(bases), "shard").select("doc_ids", "n_tokens", "payload", (F.col("base") + F.col("shard_start")).alias("start"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document, in order of start if sorted by it."""

    def make():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            doc, start, ids, ends = [], [], [], [0]
            for d, n, raw, at in zip(*(b.column(k).to_pylist() for k in ("doc_ids", "n_tokens", "payload", "start")), strict=True):
                doc += d
                start += (at + np.concatenate([[0], np.cumsum(n)[:-1]])).astype(np.int64).tolist()
                ends += (ends[-1] + np.cumsum(n)).tolist()
                ids.append(Blocks(raw).all())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), lists], names=["doc_id", "start", "ids"])

        return one

    return map_batches(files(spark, path), make, "doc_id long, start long, ids array<int>")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the ids in the files."""

    def run(batches):
        worker_state("token files", object)  # the ids are there: what tokenising remembered can go
        for b in batches:
            for d, n, raw, at in zip(*(b.column(k).to_pylist() for k in ("doc_ids", "n_tokens", "payload", "start")), strict=True):
                ids, ends = memoryview(Blocks(raw).all().astype("<u4").tobytes()), np.cumsum(n)
                begins = ends - np.array(n)
                crc = [zlib.crc32(ids[4 * s : 4 * e]) for s, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(at + begins, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


#: The id that ends each document of the query.
END_ID = 2


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as token files into the shared folder and described from them."""
    import uuid

    path = f"{shared_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write(documents(spark, sf_dir), path, tokenizer_path("word_bpe_49k.json"), END_ID)
    return digest(spark, path)
