"""Mixture-controlled packing: every window takes from the source queues by deficit round-robin.

Each source is a queue of its documents' tokens. A queue earns tokens in proportion to its target share; the next token
always comes from the queue that would be served soonest, (tokens taken + 1) / share, ties to the first source. So a
window holds each source's share to within a token, and what a queue is short of carries over to the next window. A
queue that runs empty leaves its share to the others. How many tokens each queue has given after k windows is a closed
function of k, so that any task can work out any window, and the deficits carry across partitions without a pass in order.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import arrow_table, columns, kind_of, rows_of, slices, stored, utf8
from wattline.llm.encoder import default_path, encoder


@dataclass(frozen=True)
class Schedule:
    """tokens of each queue, the rate at which each is served, tokens of a window."""

    tokens: np.ndarray
    rates: np.ndarray
    window: int

    @property
    def windows(self) -> int:
        return -(-int(self.tokens.sum()) // self.window)

    def clock(self, taken: np.ndarray) -> np.ndarray:
        """The time at which about that many tokens have been served in all."""
        stops = np.unique(np.concatenate([[0.0], self.tokens / self.rates]))
        served = np.minimum(self.tokens, stops[:, None] * self.rates).sum(axis=1)
        return np.interp(taken, served, stops)

    def served(self, time: np.ndarray) -> np.ndarray:
        return np.minimum(self.tokens, time[:, None] * self.rates).sum(axis=1)

    def given(self, k: np.ndarray) -> np.ndarray:
        """Tokens that each queue has given after k windows: a row for each k, a column for each queue."""
        wanted = np.minimum(k * self.window, self.tokens.sum())
        out = np.minimum(self.tokens, np.maximum(0, np.floor(self.clock(wanted)[:, None] * self.rates) - 2)).astype(np.int64)
        short = wanted - out.sum(axis=1)
        while (short > 0).any():
            rows = np.flatnonzero(short > 0)
            turn = np.where(out[rows] < self.tokens, (out[rows] + 1) / self.rates, np.inf).argmin(axis=1)
            out[rows, turn] += 1
            short[rows] -= 1
        return out


def pieces(schedule: Schedule, queue: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of documents that lie at `start` in their queue: (document, first id, ids, window, offset in the window)."""
    rate = schedule.rates[queue]
    slack = len(schedule.tokens) // schedule.window + 2
    first = np.maximum(0, schedule.served((start + 1) / rate) // schedule.window - slack).astype(np.int64)
    last = np.minimum(schedule.windows - 1, schedule.served((start + size) / rate) // schedule.window + slack).astype(np.int64)
    count = last - first + 1
    doc = np.repeat(np.arange(len(start)), count)
    window = np.repeat(first, count) + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    needed = np.unique(np.concatenate([window, window + 1]))
    given = schedule.given(needed)
    at, after = np.searchsorted(needed, window), np.searchsorted(needed, window + 1)
    own = queue[doc]
    low = np.maximum(start[doc], given[at, own])
    high = np.minimum(start[doc] + size[doc], given[after, own])
    real = np.flatnonzero(high > low)
    doc, window, at, after, own, low, high = (x[real] for x in (doc, window, at, after, own, low, high))
    before = np.cumsum(given[after] - given[at], axis=1)
    before = np.where(own > 0, before[np.arange(len(own)), np.maximum(own, 1) - 1], 0)
    return doc, low - start[doc], high - low, window, before + low - given[at, own]


def token_queues(docs: DataFrame, doc_id: str, text: str, source: str | None, path: str, end: int) -> DataFrame:
    """Token ids of each row, and where the row begins among its task's tokens of its source."""
    base = columns(docs, doc_id=doc_id, text=text, source=source)
    base = base.select("doc_id", "text", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("queue"))
    schema = f"doc_id {kind_of(base, 'doc_id')}, queue string, task long, begins long, n long, ids binary"
    fields = arrow_table(schema)

    def work(batches):
        task, used = TaskContext.get().partitionId(), {}
        coder = encoder(path, end)
        for b in slices(batches, 1):
            ids, sizes = coder.encode(utf8(b.column(1)))
            queues, begins = b.column(2).to_pylist(), []
            for q, n in zip(queues, sizes.tolist()):
                begins.append(used.get(q, 0))
                used[q] = begins[-1] + n
            ends = np.cumsum(sizes)
            data = [ids[e - n : e].tobytes() for e, n in zip(ends, sizes)]
            yield rows_of(fields, b.column(0), queues, [task] * len(sizes), begins, sizes, data)

    return base.mapInArrow(work, schema)


def pack(docs: DataFrame, window: int = 2048, targets: dict[str | None, float] | None = None, doc_id: str = "doc_id", text: str = "text", source: str | None = "source", path: str | None = None, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded.

    All whole texts (NULL: empty) are encoded, each followed by the end id, and cut freely: sequences are full, but for
    the last one. `targets`: the share of each source (NULL: None) in a window; without it, its share of all tokens, so
    that all queues end together. Sources without a target are served last, by their tokens. `padded`: the window, or
    for the last sequence the next power of two. A queue takes rows as they are stored, each row once, equal ones too.
    No row or queue is ever in one task: a task's tokens of a source begin where a running sum over tasks says.
    """
    path = path or default_path()
    spark = docs.sparkSession
    rows = stored(token_queues(docs, doc_id, text, source, path, end), "token-queues")
    sums = rows.groupBy("queue", "task").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("queue").orderBy("task")) - F.col("n")
    bases = stored(sums.select("queue", "task", before.alias("base"), "n"), "queue-bases")
    totals = sorted((r.queue, r.n) for r in bases.groupBy("queue").agg(F.sum("n").alias("n")).collect())
    number = {q: i for i, (q, _) in enumerate(totals)}
    tokens = np.array([n for _, n in totals], float)
    if targets is None:
        rates = tokens
    else:
        named = {"" if s is None else f"={s}": float(w) for s, w in targets.items()}
        wanted = np.array([named.get(q, 0.0) for q, _ in totals])
        least = wanted[wanted > 0].min(initial=1.0) * 1e-9
        rates = np.where(wanted > 0, wanted, least * tokens / max(tokens.sum(), 1))
    shared = spark.sparkContext.broadcast((number, Schedule(tokens.astype(np.int64), rates, window)))
    kind = np.dtype(encoder(path, end).kind)
    schema = f"doc_id {kind_of(rows, 'doc_id')}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"
    fields = arrow_table(schema)

    def work(batches):
        number, schedule = shared.value
        rest = int(schedule.tokens.sum()) % schedule.window
        for b in slices(batches, 3):
            queue = np.array([number[q] for q in b.column(1).to_pylist()])
            start, size = (b.column(i).to_numpy(zero_copy_only=False) for i in (4, 2))
            doc, first, length, sequence, offset = pieces(schedule, queue, start, size)
            ids = [np.frombuffer(x, kind).astype("<u4") for x in b.column(3).to_pylist()]
            crc = [zlib.crc32(ids[d][a : a + n]) for d, a, n in zip(doc.tolist(), first.tolist(), length.tolist())]
            short = (sequence == schedule.windows - 1) & (rest > 0)
            padded = np.where(short, 1 << max(rest - 1, 0).bit_length(), schedule.window)
            yield rows_of(fields, b.column(0).take(pa.array(doc)), first, length, crc, size[doc], sequence, offset, padded)

    placed = rows.join(bases.drop("n"), ["queue", "task"]).select("doc_id", "queue", "n", "ids", (F.col("base") + F.col("begins")).alias("at"))
    return placed.mapInArrow(work, schema)
