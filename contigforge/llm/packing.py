"""Mixture-controlled packing: deficit round-robin over source queues fills every window to the target token proportions.

A queue is a source, its target proportion by default its share of all tokens; its tokens lie in it in the order of (task that tokenised them, row). Windows of WINDOW tokens are grouped into
blocks of BLOCK windows. Where a block begins, each queue has given its share of all tokens so far, rounded by Webster's method; what
a share and the whole tokens given differ by is the deficit that is carried into the block. Inside a block, each window adds every
queue's quantum to its deficit, serves the whole tokens of it, and gives the places left to the queues of largest deficit. So any task
can work out any block alone, and no order runs through all windows.

The end of the last block, less than a window, is cut into sequences of powers of two, so that nothing is padded.

Contract of pack():
- a null or empty text is a document of the end id alone; a null source is a queue of its own;
- a null id stays null; repeated rows are packed each; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from fractions import Fraction
from functools import lru_cache
from heapq import heapify, heappop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship
from .chunks import library
from .common import checkpoint, column, documents, stage, tokenizer_path, worker_state

WINDOW = 1024
BLOCK = 512
END_ID = 0
#: Rows of a task and source that may be sent to all executors, some 40 bytes each.
BROADCAST_ROWS = 200_000
#: Bytes of each of a schedule's memories.
MEMORY = 64 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


class Schedule:
    """Who fills which place of which window, for queues of these many tokens and weights; without weights each queue weighs its tokens.

    While all queues last, their shares are as their weights; a queue that has given all leaves its share to the others.
    """

    def __init__(self, totals: list[int], window: int = WINDOW, block: int = BLOCK, weights: list[int] | None = None):
        self.totals, self.window, self.block = totals, window, block
        self.weights = [w if t else 0 for w, t in zip(weights or totals, totals, strict=True)]
        if any(w < 1 for w, t in zip(self.weights, totals, strict=True) if t):
            raise ValueError("a queue with tokens needs a weight")
        self.total = sum(totals)
        self.blocks = -(-self.total // (window * block))
        order = sorted((i for i, t in enumerate(totals) if t), key=lambda i: Fraction(totals[i], self.weights[i]))
        self.dry, gone, rest = [], 0, sum(self.weights)  # for each queue as it runs dry: tokens given by then, level, and what holds after it
        self.after = [(gone, rest)]
        for i in order:
            level = Fraction(totals[i], self.weights[i])
            self.dry.append((gone + level * rest, level))
            gone, rest = gone + totals[i], rest - self.weights[i]
            self.after.append((gone, rest))
        row = 8 * max(len(totals), 1)
        self.given = lru_cache(max(4, min(4096, MEMORY // row)))(self._given)
        held = max(2, min(64, MEMORY // (row * (block + 1))))
        self.counts, self.offsets = lru_cache(held)(self._counts), lru_cache(held)(self._offsets)
        self.columns = lru_cache(4096)(lambda block, queue: np.ascontiguousarray(self.counts(block)[:, queue]))

    def _level(self, tokens: int) -> Fraction:
        """The level up to which queues are drained when so many tokens are given: queue i has given weight * level, or all it has."""
        gone, rest = self.after[bisect_left(self.dry, tokens, key=lambda x: x[0])]
        return Fraction(tokens - gone, rest) if rest else Fraction(0)

    def ideal(self, tokens: int) -> np.ndarray:
        """What each queue should have given, not rounded."""
        if tokens >= self.total:
            return np.array(self.totals, float)
        level = float(self._level(tokens))
        return np.minimum(np.array(self.totals, float), np.array(self.weights, float) * level)

    def _given(self, tokens: int) -> np.ndarray:
        """Tokens of each queue among the first so many: Webster's rounding of the shares, which never takes a token back as tokens grows."""
        if self.total == 0 or tokens >= self.total:
            return np.array(self.totals, np.int64)
        level = self._level(tokens)
        up, down = level.numerator, level.denominator
        out = [min(t, (2 * w * up + down) // (2 * down)) for t, w in zip(self.totals, self.weights, strict=True)]
        over = sum(out) - tokens
        if over > 0:
            heap = [(-Fraction(2 * x - 1, self.weights[i]), -i) for i, x in enumerate(out) if x]
            heapify(heap)
            for _ in range(over):
                i = -heap[0][1]
                out[i] -= 1
                heapreplace(heap, (-Fraction(2 * out[i] - 1, self.weights[i]), -i)) if out[i] else heappop(heap)
        elif over < 0:
            heap = [(Fraction(2 * x + 1, self.weights[i]), i) for i, x in enumerate(out) if x < self.totals[i]]
            heapify(heap)
            for _ in range(-over):
                i = heap[0][1]
                out[i] += 1
                heapreplace(heap, (Fraction(2 * out[i] + 1, self.weights[i]), i)) if out[i] < self.totals[i] else heappop(heap)
        return np.array(out, np.int64)

    def _counts(self, block: int) -> np.ndarray:
        """Tokens given before each of the block's windows: a row for a window and one for the end, a column for a queue."""
        size = self.window * self.block
        begin, end = block * size, min((block + 1) * size, self.total)
        first, last = self.given(begin), self.given(end)
        left = last - first
        n = end - begin
        windows = -(-n // self.window)
        due = self.ideal(begin)
        deficit = due - first  # carried into the block
        out = np.empty((windows + 1, len(left)), np.int64)
        out[0] = first
        for w in range(windows):
            room = min(self.window, n - w * self.window)
            next_due = self.ideal(begin + w * self.window + room)
            deficit += next_due - due  # the window's quanta
            due = next_due
            serve = np.minimum(np.maximum(np.floor(deficit), 0).astype(np.int64), left)
            if (more := room - int(serve.sum())) < 0:
                for i in np.argsort(deficit - serve, kind="stable"):
                    back = min(int(serve[i]), -more)
                    serve[i] -= back
                    more += back
                    if not more:
                        break
            while more > 0:  # a round of one token each, by deficit, and so on while places are left
                waiting = np.flatnonzero(left > serve)
                turn = waiting[np.argsort(-(deficit - serve)[waiting], kind="stable")][:more]
                serve[turn] += 1
                more -= len(turn)
            deficit -= serve
            left = left - serve
            out[w + 1] = out[w] + serve
        return out

    def block_of(self, queue: int, position: int) -> int:
        """The block that holds this token of the queue."""
        size = self.window * self.block
        level = position / self.weights[queue]
        gone, rest = self.after[bisect_left(self.dry, level, key=lambda x: x[1])]
        low = max(0, min(self.blocks - 1, int(gone + level * rest) // size))
        while low and self.given(low * size)[queue] > position:
            low -= 1
        while self.given(min((low + 1) * size, self.total))[queue] <= position:
            low += 1
        return low

    def _offsets(self, block: int) -> np.ndarray:
        """Where each queue's tokens begin in each of the block's windows."""
        served = np.diff(self.counts(block), axis=0)
        return np.cumsum(served, 1) - served

    def pieces(self, queue: int, begin: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start in the document, length, sequence, offset) of the tokens begin .. begin + n of a queue."""
        out = []
        at, end = begin, begin + n
        while at < end:
            block = self.block_of(queue, at)
            own = self.columns(block, queue)
            stop = min(end, int(own[-1]))
            low, high = (int(x) for x in np.searchsorted(own, (at, stop - 1), "right"))
            start = np.maximum(own[low - 1 : high], at)
            length = np.minimum(own[low : high + 1], stop) - start
            number = np.arange(low - 1, high) + block * self.block
            offset = self.offsets(block)[low - 1 : high, queue] + start - own[low - 1 : high]
            out.append(np.stack([start - begin, length, number, offset])[:, length > 0])
            at = stop
        got = np.concatenate(out, 1)
        if (got[2, -1] + 1) * self.window > self.total:  # the last tokens: sequences of falling powers of two
            s, k, number, o = got[:, -1].tolist()
            rest, before, cut = self.total - number * self.window, 0, []
            for power in range(rest.bit_length() - 1, -1, -1):
                if rest >> power & 1:
                    a, e = max(o, before), min(o + k, before + (1 << power))
                    if a < e:
                        cut.append((s + a - o, e - a, number, a - before))
                    before, number = before + (1 << power), number + 1
            got = np.concatenate([got[:, :-1], np.array(cut, np.int64).T], 1)
        return got[0], got[1], got[2], got[3]


def tokenise(df: DataFrame, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", memory: tuple[int, int] | None = None) -> DataFrame:
    """(task, source, task_start, doc_id, n_tokens, ids): ids as little-endian unsigned numbers of 16 bits, or 32 where one needs them; task_start counts the tokens of the source before it in the task."""

    def run(batches):
        task, before, encoder = TaskContext.get().partitionId(), {}, library(vocabulary, False, memory)
        end = int(end_id).to_bytes(4, "little")
        for b in batches:
            sources, starts, ids, count = b.column("source").to_pylist(), [], [], []
            for s, x in zip(sources, encoder.encode(b.column("text").to_pylist()), strict=True):
                starts.append(before.get(s, 0))
                count.append(len(x) // 4 + 1)
                before[s] = starts[-1] + count[-1]
                own = np.frombuffer(x + end, "<u4")
                ids.append(own.astype("<u2").tobytes() if own.max() < 1 << 16 else x + end)
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(ids), pa.int32()), b.column("source"), pa.array(starts, pa.int64()), b.column("doc_id"), pa.array(count, pa.int64()), pa.array(ids, pa.binary())], names=["task", "source", "task_start", "doc_id", "n_tokens", "ids"])

    ship(df.sparkSession)
    rows = df.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"), column(source_col).cast("string").alias("source"))
    return rows.mapInArrow(run, "task int, source string, task_start long, doc_id long, n_tokens long, ids binary")


def pack(df: DataFrame, vocabulary: str, window: int = WINDOW, block: int = BLOCK, end_id: int = END_ID, memory: tuple[int, int] | None = None, mixture: dict[str | None, float] | None = None, **columns: str) -> DataFrame:
    """The pieces of PIECES. mixture: target proportions of sources, as long as they last; a source that it doesn't name has its share of all tokens. The ids are written once into the shared folder; sums of a row for each task and source set the queues' places. The sources with their sums are held by the driver and by each task."""
    spark = df.sparkSession
    tokens = stage(tokenise(df, vocabulary, end_id, memory=memory, **columns), "packing")
    sums = checkpoint(tokens.groupBy("source", "task").agg(F.sum("n_tokens").alias("n")))
    bases = sums.select(F.col("source").alias("b_source"), F.col("task").alias("b_task"), F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    found = sorted(((r.source, r.n) for r in sums.groupBy("source").agg(F.sum("n").alias("n")).collect()), key=lambda x: (x[0] is not None, x[0] or ""))
    names, totals = [m[0] for m in found], [int(m[1]) for m in found]
    total = max(sum(totals), 1)
    weights = [max(1, round(mixture.get(s, n / total) * (1 << 40))) for s, n in zip(names, totals, strict=True)] if mixture else None

    def run(batches):
        worker_state("packing", object)  # the ids are there: what tokenising remembered can go
        plan, place = Schedule(totals, window, block, weights), {s: i for i, s in enumerate(names)}
        for b in batches:
            parts, crc, count = [], [], []
            for source, base, n, ids in zip(*(b.column(k).to_pylist() for k in ("source", "begin", "n_tokens", "ids")), strict=True):
                wide = memoryview(ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes())
                parts.append(got := plan.pieces(place[source], base, n))
                first = (got[0] * 4).tolist()
                crc += [zlib.crc32(wide[x:y]) for x, y in zip(first, (*first[1:], 4 * n), strict=True)]
                count.append(len(first))
            row = pa.array(np.repeat(np.arange(len(count)), count))
            start, length, sequence, offset = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
            columns = [b.column("doc_id").take(row), start, length, pa.array(crc, pa.int64()), b.column("n_tokens").take(row), sequence, offset, b.column("source").take(row)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    if sums.count() <= BROADCAST_ROWS:  # else the join is by shuffle
        bases = F.broadcast(bases)
    placed = tokens.join(bases, (F.col("task") == F.col("b_task")) & F.col("source").eqNullSafe(F.col("b_source")))
    return placed.select("doc_id", "source", (F.col("base") + F.col("task_start")).alias("begin"), "n_tokens", "ids").mapInArrow(run, PIECES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences."""
    return pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
