"""Compression bands: texts that compress too well or not at all are rejected, with limits by length."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from wattline.llm.common import arrow_table, columns, kind_of, rows_of, slices

SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

#: (bytes below which the limits hold, least ratio, greatest ratio). Short texts hardly compress, whatever they say.
#: Chosen on documents labelled as good, with 50 words or more: the least ratios lie 8 % below, the greatest ones 8 % above
#: what those show. Too few are shorter than 256 bytes, so that the greatest ratios there only reject what is sure to be noise.
BANDS = (
    (128, 0.30, 9.0),
    (256, 0.40, 1.20),
    (512, 0.50, 0.806),
    (1024, 0.455, 0.745),
    (2048, 0.435, 0.651),
    (4096, 0.415, 0.595),
    (8192, 0.395, 0.553),
    (16384, 0.385, 0.500),
    (32768, 0.37, 0.476),
    (1 << 62, 0.34, 0.467),
)


@dataclass(frozen=True)
class Limits:
    """bands: limits by length; chunk: bytes of a fixed chunk; share: the part of a text's bytes that may lie in chunks
    outside their band; level: of the compressor; words and repeated: the base rule."""

    bands: tuple[tuple[int, float, float], ...] = BANDS
    chunk: int = 4096
    share: float = 0.25
    level: int = 3
    words: int = 50
    repeated: int = 50


RESULT = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, chunk_share double, kept boolean"
)


def repeat_words(words: list[bytes], k: int = 3) -> int:
    """Words in windows of k words that occur more than once in the text, the first occurrence included."""
    windows = list(zip(*(words[i:] for i in range(k))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for i in range(k):
        covered[i : len(windows) + i] |= hit
    return int(covered.sum())


def inside(size: int, packed: int, bands) -> bool:
    low, high = next((lo, hi) for below, lo, hi in bands if size < below)
    return low <= packed / size <= high


def bands_verdict(data: bytes, packer, limits: Limits) -> tuple[float, float, bool]:
    """Ratio of the whole text, the share of its bytes in chunks outside their band, and whether it passes."""
    if not data:
        return 0.0, 0.0, False
    packed = len(packer.compress(data))
    out = 0
    if len(data) > limits.chunk:
        for at in range(0, len(data), limits.chunk):
            part = data[at : at + limits.chunk]
            out += 0 if inside(len(part), len(packer.compress(part)), limits.bands) else len(part)
    share = out / len(data)
    return packed / len(data), share, inside(len(data), packed, limits.bands) and share <= limits.share


def measure(text: str | None, packer, limits: Limits) -> tuple:
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeated = repeat_words(words)
    failed = len(words) < limits.words or 100 * repeated > limits.repeated * len(words)
    ratio, share, passed = bands_verdict(data, packer, limits)
    return (
        len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated, failed, ratio, share, passed and not failed,
    )


def compression_bands(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per document: base counts, the zstandard ratios and the verdict.

    Words are runs of characters other than ASCII white space. `base_failed`: too few words, or too many of them in
    repeated windows of three. `kept` is false then; otherwise the compressed size of the whole text over its size must
    lie in the band of its length, and at most `share` of its bytes in fixed chunks outside theirs. A NULL text counts
    as empty: no words, not kept. Rows with equal or NULL ids are judged one by one. Every text is read in full, each by
    itself: there is no shuffle.
    """
    base = columns(docs, doc_id=doc_id, text=text)
    schema = RESULT.format(id=kind_of(base, "doc_id"))
    fields = arrow_table(schema)

    def work(batches):
        packer = zstandard.ZstdCompressor(level=limits.level)
        for b in slices(batches, 1):
            found = [measure(t, packer, limits) for t in b.column(1).to_pylist()]
            yield rows_of(fields, b.column(0), *([r[i] for r in found] for i in range(9)))

    return base.mapInArrow(work, schema)


def quality_stage(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The documents that `compression_bands` keeps, with all their columns as they were. A NULL or empty text goes; equal
    rows stay or go together. Texts go to Python, the rows stay where they are."""

    @F.arrow_udf(BooleanType())
    def keeps(texts: pa.Array) -> pa.Array:
        packer = zstandard.ZstdCompressor(level=limits.level)
        parts = slices(iter([pa.record_batch([texts], ["text"])]))
        return pa.array([measure(t, packer, limits)[-1] for b in parts for t in b.column(0).to_pylist()], pa.bool_())

    return docs.where(keeps(F.col(f"`{text}`")))
