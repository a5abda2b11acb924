"""What the text operators share: columns, words, hashes, stored tables and folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.session import checkpoint_dir

#: Bytes of text that are worked on together in Python; bounds what a worker holds besides the batch itself.
SLICE = 1 << 20
#: Remembered words of a task; the memory is emptied when it is full.
REMEMBERED = 300_000


def columns(docs: DataFrame, **wanted: str | None) -> DataFrame:
    """Only the wanted columns under this library's own names, so that no other column can clash with a result.

    A name of None gives a column of NULL texts.
    """
    return docs.select(*[(F.lit(None).cast("string") if c is None else docs[f"`{c}`"]).alias(n) for n, c in wanted.items()])


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts lineage and is pruned by column when read."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The column of `numbered`.
ROW = "__row_number"


def numbered(df: DataFrame) -> DataFrame:
    """df as a stored table whose rows have a number of their own: ids may be NULL or repeat."""
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


#: What a worker keeps for the tasks of one stage, by name.
KEPT: dict = {}


def tidy() -> None:
    """Let go of what tasks of other stages have left in this worker, and of memory that Arrow holds without use: workers
    live on, and an executor has more of them than tasks."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if KEPT.setdefault("stage", stage) != stage:
        KEPT.clear()
        KEPT["stage"] = stage
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], text: int = 0, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about `size` bytes of the text column, a row at least."""
    tidy()
    for batch in batches:
        if batch.num_rows:
            length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            part = (np.cumsum(length + 64) - 1) // size
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                yield batch.slice(begin, end - begin)
    tidy()


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; NULL is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


class Hashes(dict):
    """64-bit hash of each word, remembered: words repeat a lot."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of multiplied hashes are spread evenly."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k words; of the whole sequence if it is shorter; nothing without words."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = mixed(out * MIX + hashes[i : n - k + 1 + i])
    return out


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def arrow_table(schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string with simple types and arrays of them."""
    kinds = {
        "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
        "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(n, kinds[t]) for n, t in (x.strip().split(" ") for x in schema.split(","))])


def rows_of(schema: pa.Schema, *cols) -> pa.RecordBatch:
    """A batch from lists, numpy arrays or Arrow arrays, in schema order."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def lists_of(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from its concatenated values."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def each(parts: list[np.ndarray], kind=np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def rounded(n: str) -> Column:
    """A count down to three digits, so that a histogram of counts has some thousand rows at most."""
    step = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10(n)) - 2, F.lit(0))).cast("long")
    return F.col(n) - F.col(n) % step


def least_count(df: DataFrame, most: int) -> int | None:
    """The least count n from which on no more than `most` rows are left; None if there is none."""
    by_count = sorted(df.groupBy(rounded("n").alias("n")).count().collect(), reverse=True)
    above = np.cumsum([r[1] for r in by_count])
    fits = np.flatnonzero(above <= most)
    return by_count[fits[-1]][0] if len(fits) else None


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and how often each occurs."""
    codes = np.sort(codes)
    if not len(codes):
        return codes, np.empty(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[begins], np.diff(np.append(begins, len(codes)))


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sum of the counts of each."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    if not len(codes):
        return codes, counts
    begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[begins], np.add.reduceat(counts, begins)


class Tally:
    """Counts of 64-bit codes by label within a task. It holds about `most` codes; what is over is given out to be
    summed by Spark."""

    def __init__(self, most: int = 4_000_000):
        self.most, self.held, self.parts = most, 0, {}

    def add(self, label, codes: np.ndarray) -> Iterator[tuple]:
        part = distinct(codes)
        self.parts.setdefault(label, []).append(part)
        self.held += len(part[0])
        if self.held > self.most:
            self.sum()
            if self.held > self.most // 2:
                yield from self.rest()

    def sum(self) -> None:
        self.parts = {x: [summed(each([c for c, _ in p], np.uint64), each([n for _, n in p]))] for x, p in self.parts.items()}
        self.held = sum(len(p[0][0]) for p in self.parts.values())

    def rest(self) -> Iterator[tuple]:
        """(label, codes, counts), and starts anew."""
        self.sum()
        for label, ((codes, counts),) in self.parts.items():
            if len(codes):
                yield label, codes, counts
        self.parts, self.held = {}, 0


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is among the sorted keys, and its place."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at
