"""Token ids as flat unsigned integer files with 64-bit document offsets, read back by memory map.

A set of files lies in one folder on shared storage. Part NNNNN has `.ids` (little-endian unsigned integers, 16 bits wide
if all ids fit, else 32), `.off` (64-bit offsets: of each document's first id within the part, then the part's number of
ids) and `.doc` (an Arrow file with the document ids). `index.json` lists the parts in order with their bases: the number
of documents and of ids in the parts before, from prefix sums.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import arrow_table, columns, folder, kind_of, rows_of, slices, utf8
from wattline.llm.encoder import default_path, encoder


def write_token_files(docs: DataFrame, to: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end: int = 1) -> dict:
    """Encode every whole text (NULL: empty), append the end id, and write the files in ascending order of doc_id.

    NULL ids come first; equal ids are ordered by a hash of their text. Rows are dealt into ranges of the id, so each
    task writes one part, under another name until it is whole. Returns the index.
    """
    path = path or default_path()
    base = columns(docs, doc_id=doc_id, text=text)
    order = (F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    dealt = base.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part long, docs long, ids long, width long"
    fields = arrow_table(schema)
    id_type = arrow_table(f"doc_id {kind_of(base, 'doc_id')}").field(0).type

    def work(batches):
        store, root = fs.FileSystem.from_uri(to)
        store.create_dir(root)
        part, n_docs, n_ids = TaskContext.get().partitionId(), 0, 0
        coder = encoder(path, end)
        name = f"{root}/part-{part:05d}"
        draft = f"{root}/.{uuid.uuid4().hex}"
        schema = pa.schema([("doc_id", id_type)])
        with store.open_output_stream(f"{draft}.ids") as ids_file, store.open_output_stream(f"{draft}.off") as offsets, store.open_output_stream(f"{draft}.doc") as doc_file:
            with pa.ipc.new_file(doc_file, schema) as doc_ids:
                for b in slices(batches, 1):
                    ids, sizes = coder.encode(utf8(b.column(1)))
                    ids_file.write(ids.astype(ids.dtype.newbyteorder("<")).tobytes())
                    offsets.write((n_ids + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
                    doc_ids.write_batch(rows_of(schema, b.column(0)))
                    n_docs, n_ids = n_docs + b.num_rows, n_ids + len(ids)
            offsets.write(np.uint64(n_ids).astype("<u8").tobytes())
        for x in ("ids", "off", "doc"):
            if n_docs:
                store.move(f"{draft}.{x}", f"{name}.{x}")
            else:
                store.delete_file(f"{draft}.{x}")
        if n_docs:
            yield rows_of(fields, [part], [n_docs], [n_ids], [np.dtype(coder.kind).itemsize])

    parts = sorted(dealt.mapInArrow(work, schema).collect())
    doc_base = np.cumsum([0, *(p.docs for p in parts)]).tolist()
    id_base = np.cumsum([0, *(p.ids for p in parts)]).tolist()
    index = {
        "width": parts[0].width if parts else 2, "end": end, "docs": doc_base[-1], "ids": id_base[-1], "id_kind": kind_of(base, "doc_id"),
        "parts": [{"name": f"part-{p.part:05d}", "docs": p.docs, "ids": p.ids, "first_doc": d, "first_id": i} for p, d, i in zip(parts, doc_base, id_base)],
    }
    store, root = fs.FileSystem.from_uri(to)
    store.create_dir(root)
    with store.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps(index).encode())
    return index


def read_index(path: str) -> dict:
    store, root = fs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{root}/index.json") as f:
        return json.loads(f.read())


def mapped(store: fs.FileSystem, path: str) -> pa.Buffer:
    """A file's bytes, by memory map where the folder is mounted."""
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with store.open_input_file(path) as f:
        return f.read_buffer()


def documents_of(root: str, part: dict, width: int, at_once: int = 4096) -> Iterator[tuple]:
    """(document ids, place of each one's first id in the whole output, list of id arrays) of one part, a bit at a time."""
    store, folder_path = fs.FileSystem.from_uri(root)
    name = f"{folder_path}/{part['name']}"
    ids = np.frombuffer(mapped(store, f"{name}.ids"), f"<u{width}")
    offsets = np.frombuffer(mapped(store, f"{name}.off"), "<u8").astype(np.int64)
    docs = pa.ipc.open_file(pa.BufferReader(mapped(store, f"{name}.doc"))).read_all().column(0).combine_chunks()
    for a in range(0, len(docs), at_once):
        own = offsets[a : a + at_once + 1]
        yield docs.slice(a, at_once), part["first_id"] + own[:-1], [ids[x:y] for x, y in zip(own, own[1:])]


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its ids
    as little-endian 32-bit integers). One task a part."""
    index = read_index(path)
    schema = f"doc_id {index['id_kind']}, start long, n_tokens long, ids_crc32 long"
    fields = arrow_table(schema)
    if not index["parts"]:
        return spark.createDataFrame([], schema)
    parts = spark.createDataFrame([(json.dumps(p),) for p in index["parts"]], "part string").repartition(len(index["parts"]))

    def work(batches):
        for b in batches:
            for part in b.column(0).to_pylist():
                for docs, start, ids in documents_of(path, json.loads(part), index["width"]):
                    yield rows_of(fields, docs, start, [len(x) for x in ids], [zlib.crc32(x.astype("<u4")) for x in ids])

    return parts.mapInArrow(work, schema)


def token_table(docs: DataFrame, **options) -> DataFrame:
    """Write the files into a fresh shared folder and read them back."""
    to = folder(docs.sparkSession, "token-files")
    write_token_files(docs, to, **options)
    return read_token_files(docs.sparkSession, to)
