"""Repeated runs of lines, found by winnowing over line hashes.

A line is a line of the text, or a sentence of it: long lines are cut after a sentence's end, so that a passage within a
line is a run of lines too. A gram is the shortest run of lines from a line on with enough words; a window is one with
more. Each window selects its least gram, so any run of lines with a window's words that two documents share gives both
the same fingerprint. Each fingerprint is joined to its first place in the corpus, and to the first place of each whole
window that selects it, as a frequent line's first place may be in a document that shares no more than that line. The
match is extended both ways line by line, and the run is deleted where it stands later.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wattline.llm.common import MIX, arrow_table, columns, kind_of, lists_of, mixed, rows_of, signed, slices, stored, utf8

BREAK = re.compile(rb"\n|(?<=[.!?])[ \t]+")
#: Low bits of a selection key hold the place of a gram.
PLACES = 24
INVERSE = np.uint64(pow(int(MIX), -1, 1 << 64))


def lines_of(data: bytes) -> tuple[list[int], list[bytes]]:
    """Where each line with a word begins, and the line without white space around it, A-Z in lower case. What lies
    between two lines belongs to the first."""
    starts, lines, begin = [], [], 0
    low = data.lower()
    for m in BREAK.finditer(low):
        line = low[begin : m.start()].strip()
        if line:
            starts.append(begin)
            lines.append(line)
        begin = m.end()
    line = low[begin:].strip()
    if line:
        starts.append(begin)
        lines.append(line)
    return starts, lines


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def fingerprints(hashes: np.ndarray, words: np.ndarray, ends: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected grams of several documents' lines one after another: place of the first line, and the gram's hash.

    ends: the end of the document of each line.
    """
    return selected(hashes, words, ends, gram, window)[:2]


def selected(hashes: np.ndarray, words: np.ndarray, ends: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """`fingerprints`, and of each window the place of the gram that it selects, and the window's hash."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64), hashes, np.empty(0, np.int64), hashes
    before = np.concatenate([[0], np.cumsum(words)])
    gram_end = np.searchsorted(before, before[:-1] + gram)  # the first end with enough words
    window_end = np.searchsorted(before, before[:-1] + window)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(MIX, n - 1)[:n], dtype=np.uint64)])
    inside = gram_end <= ends
    stop = np.minimum(gram_end, n)
    value = mixed((sums[stop] - sums[:-1]) * powers(INVERSE, n - 1)[:n] + (stop - np.arange(n)).astype(np.uint64))
    key = (value >> np.uint64(PLACES) << np.uint64(PLACES)) | np.arange(n).astype(np.uint64)
    key = np.where(inside, key, np.uint64(2**64 - 1))
    first = np.flatnonzero(window_end <= ends)
    last = np.searchsorted(gram_end, window_end[first], "right") - 1  # the last gram within the window
    length = last - first + 1
    chosen, table, level = np.empty(len(first), np.uint64), key, 0
    while len(first) and (1 << level) <= length.max():
        own = np.flatnonzero((length >> level) == 1)
        chosen[own] = np.minimum(table[first[own]], table[last[own] - (1 << level) + 1])
        table = np.minimum(table, np.concatenate([table[1 << level :], np.full(min(1 << level, n), 2**64 - 1, np.uint64)])[:n])
        level += 1
    of_window = (chosen & np.uint64((1 << PLACES) - 1)).astype(np.int64)
    place, until = np.unique(of_window), window_end[first]
    whole = mixed((sums[until] - sums[first]) * powers(INVERSE, n - 1)[first] + (until - first).astype(np.uint64))
    return place, value[place], of_window, whole


def text_hash(text: str) -> Column:
    """64 bits by which texts are told apart; NULL is as the empty text."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def line_rows(docs: DataFrame, gram: int, window: int) -> DataFrame:
    """Per row of (doc_id, text, text_hash): text_hash, hashes and words of its lines, places and hashes of its fingerprints, and
    those of its windows (the place of the gram that each selects)."""
    schema = f"doc_id {kind_of(docs, 'doc_id')}, text_hash long, hashes array<long>, words array<int>, places array<int>, grams array<long>, window_places array<int>, windows array<long>"
    fields = arrow_table(schema)

    def work(batches):
        for b in slices(batches, 1):
            texts = utf8(b.column(1))
            lines = [lines_of(t)[1] for t in texts]
            n = np.array([len(x) for x in lines])
            flat = np.fromiter((xxhash.xxh3_64_intdigest(x) for d in lines for x in d), np.uint64, n.sum())
            words = np.fromiter((len(x.split()) for d in lines for x in d), np.int32, n.sum())
            ends = np.cumsum(n)
            place, value, of_window, whole = selected(flat, words, np.repeat(ends, n), gram, window)
            of, window_of = (np.searchsorted(ends, x, "right") for x in (place, of_window))
            found, windows = (np.bincount(x, minlength=len(n)) for x in (of, window_of))
            yield rows_of(
                fields, b.column(0), b.column(2), lists_of(signed(flat), n, pa.int64()), lists_of(words, n, pa.int32()),
                lists_of((place - (ends - n)[of]).astype(np.int32), found, pa.int32()), lists_of(signed(value), found, pa.int64()),
                lists_of((of_window - (ends - n)[window_of]).astype(np.int32), windows, pa.int32()), lists_of(signed(whole), windows, pa.int64()),
            )

    return docs.mapInArrow(work, schema)


def extended(pairs: DataFrame) -> DataFrame:
    """Matched runs of lines (doc_id, text_hash, low, high) from rows (doc_id, text_hash, hashes, first_hashes, at,
    first_at): the lists of places hold one entry for each fingerprint of the document found first in that other one."""
    schema = f"doc_id {kind_of(pairs, 'doc_id')}, text_hash long, low int, high int"
    fields = arrow_table(schema)

    def work(batches):
        for b in batches:
            row, lows, highs = [], [], []
            for i in range(b.num_rows):
                mine, other = (b.column(c)[i].values.to_numpy() for c in (2, 3))
                covered: dict[int, int] = {}
                for p, q in sorted(zip(b.column(4)[i].as_py(), b.column(5)[i].as_py())):
                    if p < covered.get(p - q, 0):
                        continue
                    n = min(len(mine) - p, len(other) - q)
                    differs = np.flatnonzero(mine[p : p + n] != other[q : q + n])
                    high = p + (int(differs[0]) if len(differs) else n)
                    m = min(p, q)
                    differs = np.flatnonzero(mine[p - m : p] != other[q - m : q])
                    low = p - m + (int(differs[-1]) + 1 if len(differs) else 0)
                    covered[p - q] = high
                    row.append(i)
                    lows.append(low)
                    highs.append(high)
            yield rows_of(fields, b.column(0).take(pa.array(row, pa.int64())), b.column(1).take(pa.array(row, pa.int64())), lows, highs)

    return pairs.select("doc_id", "text_hash", "hashes", "first_hashes", "at", "first_at").mapInArrow(work, schema)


def repeated_runs(base: DataFrame, gram: int, window: int) -> DataFrame:
    """doc_id, text_hash and the runs (low, high) of lines that also stand earlier."""
    lines = stored(line_rows(base.withColumn("text_hash", text_hash("text")), gram, window), "lines").dropDuplicates(["doc_id", "text_hash"])
    lines = stored(lines, "distinct-lines")
    marks = lines.select("doc_id", "text_hash", F.explode(F.arrays_zip("places", "grams")).alias("f")).select("doc_id", "text_hash", F.col("f.places").alias("at"), F.col("f.grams").alias("gram"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "at")
    firsts = marks.groupBy("gram").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = stored(firsts, "first-places")  # a table of its own, so that Spark can split a gram with many places
    later = marks.join(firsts, "gram").where(order != F.col("first"))
    # the first place of a whole window may be a later one than that of its gram
    wholes = lines.select("doc_id", "text_hash", F.explode(F.arrays_zip("window_places", "windows")).alias("f")).select("doc_id", "text_hash", F.col("f.window_places").alias("at"), F.col("f.windows").alias("window"))
    first_wholes = wholes.groupBy("window").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first_wholes = stored(first_wholes, "first-windows")
    later = later.drop("gram").unionByName(wholes.join(first_wholes, "window").where(order != F.col("first")).drop("window"))
    by_pair = later.groupBy("doc_id", "text_hash", F.col("first.doc_id").alias("first_doc"), F.col("first.text_hash").alias("first_hash")).agg(
        F.sort_array(F.collect_set(F.struct("at", F.col("first.at").alias("first_at")))).alias("places")
    )
    pairs = stored(by_pair, "pairs")
    own = lines.select("doc_id", "text_hash", "hashes")
    other = lines.select(F.col("doc_id").alias("o"), F.col("text_hash").alias("first_hash"), F.col("hashes").alias("first_hashes"))
    with_other = pairs.join(other, (F.col("first_doc").eqNullSafe(F.col("o"))) & (pairs["first_hash"] == other["first_hash"]))
    with_other = with_other.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "first_hashes", F.col("places.at").alias("at"), F.col("places.first_at").alias("first_at"))
    both = with_other.join(own, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")))
    return extended(both).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("low", "high")).alias("runs"))


def without(data: bytes, runs: list, least: int) -> tuple[bytes, int, int, int]:
    """The text without the runs, joined where they touch, that have `least` words; lines, lines and words deleted."""
    starts, lines = lines_of(data)
    gone = np.zeros(len(lines) + 2, bool)
    for run in runs:
        gone[run["low"] + 1 : run["high"] + 1] = True
    edges = np.flatnonzero(gone[1:] != gone[:-1])
    out, at, deleted, words = [], 0, 0, 0
    for low, high in edges.reshape(-1, 2).tolist():
        n = sum(len(x.split()) for x in lines[low:high])
        if n >= least:
            out.append(data[at : starts[low]])
            at = starts[high] if high < len(lines) else len(data)
            deleted, words = deleted + high - low, words + n
    out.append(data[at:])
    return b"".join(out), len(lines), deleted, words


def deduplicated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram_words: int = 25, window_words: int = 50) -> DataFrame:
    """One row per row: doc_id, text without later repeated runs, n_lines, n_deleted and deleted_words.

    Documents are ordered by id (NULL last) and a hash of their text; in them lines by place. A run of lines is deleted
    as far as it matches the first place of one of its fingerprints or windows, if the lines so found make up `window_words` words
    or more; a shorter one stays. Lines are equal without the white space around them and the case of A-Z. Rows that are
    equal in id and text are one document, and all lose the same. A NULL text stays NULL.
    """
    base = columns(docs, doc_id=doc_id, text=text)
    joined = _with_runs(base, base, "doc_id", "text", gram_words, window_words).select("doc_id", "text", RUNS)
    schema = f"doc_id {kind_of(base, 'doc_id')}, text string, n_lines long, n_deleted long, deleted_words long"
    fields = arrow_table(schema)

    def work(batches):
        for b in slices(batches, 1):
            found = [without(t, r or [], window_words) for t, r in zip(utf8(b.column(1)), b.column(2).to_pylist())]
            texts = [None if null else f[0].decode() for f, null in zip(found, b.column(1).is_null().to_pylist())]
            yield rows_of(fields, b.column(0), texts, *([f[i] for f in found] for i in (1, 2, 3)))

    return joined.mapInArrow(work, schema)


def line_stage(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram_words: int = 25, window_words: int = 50) -> DataFrame:
    """The documents with all their columns, and in `text` what `deduplicated_lines` leaves; without those of which no
    word is left. A document that loses nothing stays as it is, a NULL or empty text, too."""
    base = columns(docs, doc_id=doc_id, text=text)
    joined = _with_runs(docs, base, doc_id, text, gram_words, window_words)

    @F.arrow_udf(StringType())
    def left(texts: pa.Array, runs: pa.Array) -> pa.Array:
        return pa.array([without(t, r, window_words)[0].decode() if r else None for t, r in zip(utf8(texts), runs.to_pylist())], pa.string())

    # only texts that lose something go to Python; the rows stay where they are
    marked = joined.withColumn(LEFT, left(F.when(F.col(RUNS).isNotNull(), F.col(f"`{text}`")), F.col(RUNS)))
    marked = marked.where(F.col(LEFT).isNull() | F.col(LEFT).rlike(WORD))
    return marked.select(*[F.coalesce(F.col(LEFT), F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


RUNS, HASH, RUN_ID, RUN_HASH, LEFT = "__line_runs", "__line_text_hash", "__line_doc_id", "__line_run_hash", "__line_left"
WORD = r"[^\x20\x09-\x0D]"


def _with_runs(rows: DataFrame, base: DataFrame, doc_id: str, text: str, gram: int, window: int) -> DataFrame:
    """`rows` with the runs of each, found in `base`, its ids and texts."""
    runs = stored(repeated_runs(base, gram, window), "runs").select(F.col("doc_id").alias(RUN_ID), F.col("text_hash").alias(RUN_HASH), F.col("runs").alias(RUNS))
    keyed = rows.withColumn(HASH, text_hash(text))
    return keyed.join(runs, F.col(RUN_ID).eqNullSafe(F.col(f"`{doc_id}`")) & (F.col(RUN_HASH) == F.col(HASH)), "left")
