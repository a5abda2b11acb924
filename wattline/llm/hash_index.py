"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash of its normalised bytes; the leading bits of the key pick a slot of the directory, and the
slot a bucket. A bucket that would hold more than its capacity is split by one more bit; the directory doubles when that
bucket had as many bits as the directory. Each bucket is a range of keys with one owner task, which chains the entries of
a key, compares their bytes, and writes the bucket's entries.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import arrow_table, columns, kind_of, rows_of, signed, slices, stored, utf8

#: Bytes that an entry takes beside its text.
ENTRY = 100


@dataclass(frozen=True)
class Directory:
    """depth: leading bits of a slot; slots: the bucket of each; bits: of each bucket."""

    depth: int
    slots: np.ndarray
    bits: list[int]

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        """The bucket of each key, an unsigned 64-bit number."""
        return self.slots[(keys >> np.uint64(64 - self.depth)).astype(np.int64)] if self.depth else np.zeros(len(keys), np.int64)


def grown(loads: np.ndarray, capacity: int) -> Directory:
    """The directory over keys whose load by leading bits is `loads` (a power of two of them): buckets split until each
    fits or no bits are left."""
    most = len(loads).bit_length() - 1
    sums = np.concatenate([[0], np.cumsum(loads)])
    depth, slots, bits = 0, np.zeros(1, np.int64), [0]
    begins = [0]
    todo = [0]
    while todo:
        b = todo.pop()
        width = len(loads) >> bits[b]
        if bits[b] == most or sums[begins[b] + width] - sums[begins[b]] <= capacity:
            continue
        if bits[b] == depth:  # the directory doubles: every slot becomes two
            depth, slots = depth + 1, np.repeat(slots, 2)
        new = len(bits)
        bits[b] += 1
        bits.append(bits[b])
        begins.append(begins[b] + width // 2)
        at = begins[new] >> (most - depth)
        slots[at : at + (1 << depth - bits[new])] = new
        todo += [b, new]
    return Directory(depth, slots, bits)


def entries(docs: DataFrame) -> DataFrame:
    """doc_id, key, sha, size of each row of (doc_id, text)."""
    schema = f"doc_id {kind_of(docs, 'doc_id')}, key long, sha string, size long"
    fields = arrow_table(schema)

    def work(batches):
        for b in slices(batches, 1):
            texts = [t.lower() for t in utf8(b.column(1))]
            yield rows_of(fields, b.column(0), keys_of(texts), [hashlib.sha256(t).hexdigest() for t in texts], [len(t) for t in texts])

    return docs.mapInArrow(work, schema)


def keys_of(texts: list[bytes]) -> np.ndarray:
    return signed(np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts)))


def bit_set(keys: DataFrame, bits: int) -> np.ndarray:
    """Which remainders of the keys modulo `bits` occur, as 64-bit words: a table of fixed size, whatever the keys are."""
    place = F.pmod("key", F.lit(bits))
    words = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(key, {bits}) % 64 as int))")).alias("set")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return out.view(np.uint64)


def candidates(docs: DataFrame, repeated: np.ndarray) -> DataFrame:
    """key, text (normalised bytes), doc_id of the rows whose key may occur more than once."""
    schema = f"key long, text binary, doc_id {kind_of(docs, 'doc_id')}"
    fields = arrow_table(schema)
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def work(batches):
        words = shared.value
        for b in slices(batches, 1):
            texts = [t.lower() for t in utf8(b.column(1))]
            keys = keys_of(texts)
            place = keys % (len(words) << 6)
            hit = np.flatnonzero(words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1))
            if len(hit):
                yield rows_of(fields, keys[hit], [texts[i] for i in hit], b.column(0).take(pa.array(hit)))

    return docs.mapInArrow(work, schema)


def chained(bucket: pa.Table) -> pa.Table:
    """The entries of a bucket: those of a key with equal bytes are one, with the largest id and all rows counted."""
    kept: dict[int, list[list]] = {}
    for b, key, text, doc_id, n in zip(*(c.to_pylist() for c in bucket.columns)):
        chain = kept.setdefault(key, [])
        same = next((e for e in chain if e[0] == text), None)
        if same is None:
            chain.append([text, doc_id, n, b])
        else:
            same[1] = max((x for x in (same[1], doc_id) if x is not None), default=None)
            same[2] += n
    rows = [(b, key, i, hashlib.sha256(text).hexdigest(), doc_id, n, text) for key, chain in kept.items() for i, (text, doc_id, n, b) in enumerate(chain)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), bucket.schema.field("doc_id").type, pa.int64(), pa.binary()]
    names = ["bucket", "key", "link", "sha", "keep_id", "group_size", "text"]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def build_index(docs: DataFrame, found: DataFrame, capacity: int, bits: int) -> tuple[DataFrame, Directory]:
    """The index over texts that may have copies: bucket, key, link (place in the key's chain), sha, keep_id, group_size,
    text. `found`: entries of all rows."""
    repeated = found.groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("size")).where("n > 1")
    rows = candidates(docs, bit_set(repeated, bits))
    texts = stored(rows.groupBy("key", "text").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("n")), "texts")
    load = F.length("text") + ENTRY
    total = texts.agg(F.coalesce(F.sum(load), F.lit(0))).first()[0]
    most = max(0, int(np.ceil(np.log2(max(1, total / capacity))))) + 4
    loads = np.zeros(1 << most, np.int64)
    for slot, n in texts.groupBy(F.shiftrightunsigned("key", 64 - most).alias("slot")).agg(F.sum(load)).collect():
        loads[slot] = n
    directory = grown(loads, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(directory)
    owned = f"bucket long, key long, text binary, doc_id {kind_of(docs, 'doc_id')}, n long"
    fields = arrow_table(owned)

    def assign(batches):
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield rows_of(fields, shared.value.bucket(keys), *b.columns)

    schema = f"bucket long, key long, link long, sha string, keep_id {kind_of(docs, 'doc_id')}, group_size long, text binary"
    index = texts.mapInArrow(assign, owned).groupBy("bucket").applyInArrow(chained, schema)
    return stored(index, "hash-index"), directory


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 1 << 20, bits: int = 1 << 23) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are after lower-casing A-Z; NULL is empty. Of equal texts the row with the largest id
    stays (NULL ids are smaller than any; of rows that also share the id, one). Only texts whose key occurs twice or more
    are brought together: a set of `bits` bits tells them in a second reading, and equal ones are merged before they
    reach their bucket's owner, so a bucket holds about `capacity` bytes however many copies there are.
    """
    base = columns(docs, doc_id=doc_id, text=text)
    found = stored(entries(base), "entries")
    index, _ = build_index(base, found, capacity, bits)
    rows = found.groupBy("doc_id", "key", "sha").agg(F.count("*").alias("copies"))
    joined = rows.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    copy = joined.withColumn("keep", keep).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copy.select(
        "doc_id", F.col("keep").alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("copy") == 1)).alias("kept"), F.col("sha").alias("text_sha256"),
    )
