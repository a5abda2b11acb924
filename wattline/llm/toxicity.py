"""Compression-distance classification: how much better a dictionary of toxic text compresses a text's windows than a
dictionary of ordinary text does.

A window is the beginning of a word, as words are told apart and remembered cheaply. The ordinary dictionary is trained by
zstandard on ordinary texts. The toxic one holds, besides, what words of toxic texts begin with and words of ordinary texts
hardly ever do, counted over all labelled texts. A window's gain is its compressed length with the ordinary dictionary less
that with the toxic one. How many windows reach a gain, and the text's length, become a probability, calibrated on texts that
the dictionaries had not seen.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import REMEMBERED, arrow_table, columns, kind_of, rows_of, slices, stored, utf8

MARKS = b".,;:!?\"'()[]{}<>*#$%&|-_/\\"
#: Bytes of a window: the beginning of a word with the space before it. zstandard begins no match in the last eight bytes
#: of what it compresses, so that a window is matched from its beginning or not at all.
WINDOW = 9
#: Stands before every window and at the end of both dictionaries: too short a text is not compressed at all.
LEAD = b"=<every window begins so>="
#: Bytes of marks in one dictionary. A match further back costs one byte more, and with a dictionary of over 16 KiB in all
#: zstandard begins no match in the last sixteen bytes.
PART = 4_000
#: One mark of many in a row: each begins with a space, and one that ends with a word's end has the space behind it, too.
MARK = re.compile(rb" [^ \n]+(?: \n*(?= |\Z))?")
#: Beginnings that a task holds counts of.
HELD = 200_000
PARAMETERS = dict(
    format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
    strategy=zstandard.STRATEGY_LAZY2, min_match=5, window_log=20, hash_log=15, chain_log=16, search_log=4, target_length=16,
)


@dataclass(frozen=True)
class Training:
    """Bounds of the sample that calibrates, and settings of the dictionaries.

    rows, sample_bytes: at most so many labelled texts of each class, the first by the checksum of their id, of so many
    bytes together, none of them longer than text_bytes, train the ordinary dictionary and calibrate. ordinary_bytes: the
    former's size; the toxic one has room for all there is. widths: bytes of a window's beginning. lift: such a beginning
    goes into the toxic dictionary if its share of all words is so many times that in ordinary texts, and if so many of the
    texts that have it would be toxic by chance this seldom (chance), toxic copies counted once; of beginnings of one another,
    the shortest. gain: bytes by which a window counts. limit: least score of what counts as toxic.
    """

    rows: int = 3_000
    sample_bytes: int = 8 << 20
    text_bytes: int = 1 << 20
    ordinary_bytes: int = 1 << 13
    widths: tuple[int, ...] = (6, 7, 8)
    lift: float = 20.0
    chance: float = 1e-3
    gain: int = 3
    limit: float = 0.7


class Length:
    """Compressed length of a window with one dictionary."""

    def __init__(self, content: bytes):
        kind = zstandard.ZstdCompressionDict(content + LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
        kind.precompute_compress(compression_params=parameters)
        self.packer = zstandard.ZstdCompressor(dict_data=kind, compression_params=parameters)

    def __call__(self, window: bytes) -> int:
        return len(self.packer.compress(LEAD + window))


def window_of(word: bytes) -> bytes:
    return (b" " + word.strip(MARKS) + b" ").ljust(WINDOW, b"\n")[:WINDOW]


class Gains(dict):
    """Gain of each word, remembered; the memory is emptied when it is full.

    The marks stand in parts, in sorted order: what begins a window is in the part whose first mark is the last one not
    above it, as no mark is the beginning of another.
    """

    def __init__(self, ordinary: bytes, toxic: bytes):
        super().__init__()
        self.ordinary, self.firsts, self.toxic = Length(ordinary), [], []
        found = MARK.findall(toxic)
        order, place = sorted(found), {m: i for i, m in enumerate(found)}
        sizes = np.cumsum([len(m) for m in order]) // PART
        for part in np.unique(sizes):
            marks = order[np.searchsorted(sizes, part) : np.searchsorted(sizes, part, "right")]
            self.firsts.append(marks[0])
            self.toxic.append(Length(ordinary + b"".join(sorted(marks, key=place.get))))

    def __missing__(self, word: bytes) -> int:
        window, gain = window_of(word), 0
        if self.toxic:
            part = self.toxic[max(bisect_right(self.firsts, window) - 1, 0)]
            gain = self.ordinary(window) - part(window)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) < 256:
            self[word] = gain
        return gain


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def beginnings(word: bytes, widths: tuple[int, ...]) -> set[bytes]:
    """What begins the word's window; nothing for a word of punctuation."""
    window = window_of(word)
    return {window[:w] for w in widths} if window[1:2] != b" " else set()


class Tally:
    """How often each beginning occurs and in how many texts; at b"", all words and all texts."""

    def __init__(self, widths: tuple[int, ...], texts: Iterable[Counter] = ()):
        self.widths, self.words, self.texts = widths, Counter(), Counter()
        for t in texts:
            self.add(t)

    def add(self, words: Counter) -> None:
        here = Counter({b"": words.total()})
        for word, n in words.items():
            for s in beginnings(word, self.widths):
                here[s] += n
        self.words.update(here)
        self.texts.update(here.keys())


def tells(theirs, alone, ours, others, totals: list[int], settings: Training, log=np.log, greatest=np.maximum):
    """Whether a beginning marks toxic texts, by how often it occurs in toxic and in ordinary text and in how many texts of
    either (theirs, alone, ours, others), of the totals of these four; toxic copies should count once. Of numpy arrays, or of
    columns with their own log and greatest.
    """
    p = (totals[1] + 0.5) / (totals[1] + totals[3] + 1)
    n = greatest(alone + others, 1)
    # Chernoff's bound of the chance that so many of the texts which have it are toxic; where all are, it is exact
    evidence = alone * log(greatest(alone, 1) / (n * p)) + others * log(greatest(others, 1) / (n * (1 - p)))
    often = theirs * (max(totals[2], 1) / max(totals[0], 1)) >= settings.lift * (ours + 0.5)
    return often & (alone > n * p) & (evidence >= -np.log(settings.chance))


def shortest(texts: dict[bytes, int], widths: tuple[int, ...]) -> list[bytes]:
    """Those that none of the others begins, those of the most texts last."""
    known: set[bytes] = set()
    for s in sorted(texts, key=len):
        if not any(s[:w] in known for w in widths if w < len(s)):
            known.add(s)
    return sorted(known, key=lambda s: (texts[s], s))


def rare_beginnings(toxic: list[Counter], ordinary: list[Counter], settings: Training) -> list[bytes]:
    """Beginnings of words that mark toxic texts, those of the most texts last. The texts count as no copies of one another."""
    tallies = [Tally(settings.widths, t) for t in (toxic, ordinary)]
    found = [s for s in tallies[0].texts if s]
    counts = [np.array([c[s] for s in found], np.int64) for t in tallies for c in (t.words, t.texts)]
    telling = tells(*counts, [c[b""] for t in tallies for c in (t.words, t.texts)], settings)
    return shortest({s: tallies[0].texts[s] for s, x in zip(found, telling) if x}, settings.widths)


def dictionaries(toxic: list[Counter], ordinary: list[Counter], settings: Training, marks: list[bytes] | None = None) -> tuple[bytes, bytes]:
    """The ordinary dictionary, without words that begin as those in the toxic one do, and the toxic one. marks: those of more texts
    than these."""
    marks = rare_beginnings(toxic, ordinary, settings) if marks is None else marks
    known = set(marks)
    kept = ([w for w in t if known.isdisjoint(beginnings(w, settings.widths))] for t in ordinary)
    texts = [b" " + b" ".join(words) + b" " for words in kept if words]
    try:
        trained = zstandard.train_dictionary(settings.ordinary_bytes, texts, k=64, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to train on: the texts themselves
        trained = b"".join(texts)[-settings.ordinary_bytes :]
    return trained, b"".join(marks)


def features(words: Counter, gains: Gains, gain: int) -> list[float]:
    total = words.total()
    n = sum(c for w, c in words.items() if gains[w] >= gain)
    return [1.0, np.log1p(total), np.log1p(n), np.log((n + 0.05) / (total + 5))]


@dataclass(frozen=True)
class Model:
    """Dictionaries and the weights of the calibration; without dictionaries every score is `base`."""

    settings: Training
    base: float
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = ()


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic curve, by Newton's steps. Ridge on all but the first, in units of the features' spread."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    mean[0], spread[0] = 0.0, 1.0
    z, w = (x - mean) / spread, np.zeros(x.shape[1])
    penalty = ridge * (np.arange(len(w)) > 0) + 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
    out = w / spread
    out[0] = w[0] - (out[1:] * mean[1:]).sum()
    return out


def fit_sample(
    toxic: list[bytes],
    ordinary: list[bytes],
    odds: float | None = None,
    settings: Training = Training(),
    halves: tuple[list[int], list[int]] | None = None,
    marks: list[list[bytes]] | None = None,
) -> Model:
    """The model of labelled texts. The calibration sees each text through dictionaries of the other half. odds: of toxic
    to ordinary texts where the sample was taken, those of the sample unless given. halves: the half, 0 or 1, of each text. marks:
    those of either half and of all texts where the sample was taken."""
    own = len(toxic) / max(len(ordinary), 1)
    odds = own if odds is None else odds
    if min(len(toxic), len(ordinary)) < 4:
        return Model(settings, min(odds / (1 + odds), settings.limit / 2))
    halves = halves or tuple([i % 2 for i in range(len(t))] for t in (toxic, ordinary))
    marks = marks or [None] * 3
    classes = [[Counter(words_of(t)) for t in texts] for texts in (toxic, ordinary)]
    x, y = [], []
    for half in (0, 1):
        of, seen = ([[t for t, h in zip(c, which) if h == k] for c, which in zip(classes, halves)] for k in (half, 1 - half))
        gains = Gains(*dictionaries(*of, settings, marks[half]))
        for label, texts in ((0, seen[1]), (1, seen[0])):
            x += [features(t, gains, settings.gain) for t in texts]
            y += [label] * len(texts)
    weights = calibrated(np.array(x), np.array(y, float))
    weights[0] += np.log(odds / own)
    return Model(settings, odds / (1 + odds), *dictionaries(*classes, settings, marks[2]), tuple(weights.tolist()))


def count_batches(batches, widths: tuple[int, ...]) -> Iterator[tuple]:
    """(beginnings, side, how often, in how many texts) of texts and the side that each is of; b"" stands for all."""
    held: dict[int, Tally] = {}

    def rest() -> Iterator[tuple]:
        for side, t in held.items():
            yield t.words, [side] * len(t.words), t.words.values(), (t.texts[s] for s in t.words)
        held.clear()

    for b in slices(batches):
        for text, side in zip(utf8(b.column(0)), b.column(1).to_pylist()):
            held.setdefault(side, Tally(widths)).add(Counter(words_of(text)))
            if sum(len(t.words) for t in held.values()) > HELD:
                yield from rest()
    yield from rest()


class Among(dict):
    """Numbers of the parts that are among a word's beginnings, remembered; the memory is emptied when it is full."""

    def __init__(self, parts: list[bytes], widths: tuple[int, ...]):
        super().__init__()
        self.number, self.widths = {s: i for i, s in enumerate(parts)}, widths

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        found = tuple(self.number[s] for s in beginnings(word, self.widths) if s in self.number)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) < 256:
            self[word] = found
        return found


def sights(words: list[bytes], among: Among) -> dict[int, tuple[int, int]]:
    """For each part that a text has: hashes of the words around the first one and of the text. Near copies have the same text
    hash as often as they share words, and mostly the same words around."""
    seen: dict[int, tuple[int, int]] = {}
    for i, w in enumerate(words):
        for k in among[w]:
            if k not in seen:
                seen[k] = hash_of(b" ".join([*words[max(i - 1, 0) : i], b"", *words[i + 1 : i + 2]])), 0
    whole = min(map(hash_of, set(words))) if seen else 0
    return {k: (around, whole) for k, (around, _) in seen.items()}


def hash_of(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def sight_batches(batches, parts: list[bytes], widths: tuple[int, ...]) -> Iterator[tuple]:
    """(numbers of parts, half, kind of hash, hash, in how many texts) of texts and their half."""
    among, held = Among(parts, widths), Counter()
    for b in slices(batches):
        for text, half in zip(utf8(b.column(0)), b.column(1).to_pylist()):
            for k, found in sights(words_of(text), among).items():
                held.update((k, half, kind, h) for kind, h in enumerate(found))
        if len(held) > HELD:
            yield *zip(*held), held.values()
            held.clear()
    if held:
        yield *zip(*held), held.values()


def in_tasks(df: DataFrame, schema: str, work) -> DataFrame:
    """Columns that `work` gives of the batches of df."""
    fields = arrow_table(schema)
    return df.mapInArrow(lambda batches: (rows_of(fields, *map(list, rows)) for rows in work(batches)), schema)


def all_marks(labelled: DataFrame, settings: Training) -> list[list[bytes]]:
    """The marks of texts with a label and a half, of all of them: those of either half, and of both."""
    widths = settings.widths
    labelled = stored(labelled, "labelled")
    # toxic texts of either half, then the ordinary ones
    sides = labelled.select("text", (2 * (1 - F.col("label")) + F.col("half")).cast("int").alias("side"))
    counted = in_tasks(sides, "part binary, side int, n long, texts long", lambda batches: count_batches(batches, widths))
    names = [f"{c}{side}" for side in range(4) for c in ("n", "texts")]
    sums = [F.sum(F.when(F.col("side") == int(c[-1]), F.col(c[:-1])).otherwise(0)).alias(c) for c in names]
    counts = stored(counted.groupBy("part").agg(*sums), "beginnings")
    total = counts.where(F.col("part") == b"").first()
    fits = [[(f"n{h}", f"texts{h}", f"n{h + 2}", f"texts{h + 2}") for h in halves] for halves in ((0,), (1,), (0, 1))]
    totals = [[sum(total[c] for c in kind) for kind in zip(*f)] for f in fits]
    wanted = F.lit(False)
    for f, t in zip(fits, totals):
        own = [sum((F.col(c) for c in kind[1:]), F.col(kind[0])) for kind in zip(*f)]
        wanted |= tells(*own, t, settings, F.log, lambda a, b: F.greatest(a, F.lit(b)))
    found = counts.where(F.col("part") != b"").where(wanted).orderBy("part").collect()
    parts = [bytes(r.part) for r in found]
    if not parts:
        return [[], [], []]
    toxic, shared = labelled.where("label = 1").select("text", "half"), labelled.sparkSession.sparkContext.broadcast(parts)
    seen = in_tasks(toxic, "part int, half int, kind int, hash long, n long", lambda batches: sight_batches(batches, shared.value, widths))
    of = [F.sum(F.when(F.col("half").isin(h), F.col("n")).otherwise(0)).cast("double").alias(f"n{i}") for i, h in enumerate(([0], [1], [0, 1]))]
    # texts if all classes of equal ones were of one size: a class of copies and its odd members are hardly more than one
    apart = seen.groupBy("part", "kind", "hash").agg(*of).groupBy("part", "kind")
    sizes = [F.pow(F.sum(f"n{i}"), 2) / F.greatest(F.sum(F.pow(f"n{i}", 2)), F.lit(1.0)) for i in range(len(fits))]
    alone = np.zeros((len(fits), len(parts)))
    for r in apart.agg(*sizes).collect():
        alone[:, r.part] = np.maximum(alone[:, r.part], r[2:])
    out = []
    for f, t, a in zip(fits, totals, alone):
        own = [np.array([sum(r[c] for c in kind) for r in found], np.int64) for kind in zip(*f)]
        out.append(shortest({s: int(n) for s, n, x in zip(parts, own[1], tells(own[0], a, *own[2:], t, settings)) if x}, widths))
    return out


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", settings: Training = Training()) -> Model:
    """The model of the labelled documents (those for which `train`, a condition on `labels`, holds): the toxic dictionary from all of
    them, the ordinary one and the calibration from a bounded sample.

    Of repeated labels of an id the greatest counts, of repeated documents the least text; NULL labels, ids and texts are
    not learned from. Few or no labels: a model that gives everything the share of toxic ones, below the limit.
    """
    known = labels if train is None else labels.where(train)
    known = columns(known, doc_id=doc_id, label=label).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("label") > 0, 1).otherwise(0)).alias("label"))
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    every = columns(docs, doc_id=doc_id, text=text)
    own = every.where(F.octet_length("text") <= settings.text_bytes)
    sizes = own.select("doc_id", F.octet_length("text").alias("size")).join(known, "doc_id")
    order = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)).cast("int").alias("half")
    chosen = []
    for value in (0, 1):
        first = sizes.where(F.col("label") == value).orderBy(order, "doc_id", "size").limit(settings.rows).collect()
        within = np.cumsum([r["size"] for r in first]) <= settings.sample_bytes
        chosen += [(r.doc_id, value) for r, fits in zip(first, within) if fits]
    ids = docs.sparkSession.createDataFrame(list(dict.fromkeys(chosen)), f"doc_id {kind_of(known, 'doc_id')}, label int")
    rows = own.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("*", half).collect()
    rows.sort(key=lambda r: str(r.doc_id))
    texts, halves = ([[x(r) for r in rows if r.label == value] for value in (1, 0)] for x in (lambda r: r.text.encode(), lambda r: r.half))
    odds = counts[1] / counts[0] if min(counts.get(0, 0), counts.get(1, 0)) else None
    if min(map(len, texts)) < 4:
        return fit_sample(*texts, odds, settings)
    labelled = every.where("text IS NOT NULL").join(known, "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
    return fit_sample(*texts, odds, settings, halves, all_marks(labelled.select("text", "label", half), settings))


def score_batches(model: Model, batches) -> Iterator[tuple]:
    """(batch, scores) in slices."""
    gains = Gains(model.ordinary, model.toxic) if model.weights else None
    weights = np.array(model.weights)
    for b in slices(batches, 1):
        if gains is None:
            yield b, np.full(b.num_rows, model.base)
            continue
        x = np.array([features(Counter(words_of(t)), gains, model.settings.gain) for t in utf8(b.column(1))])
        yield b, 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def scores(docs: DataFrame, model: Model, held_out: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from the model's limit on) of every row of docs.

    Whole texts are read, each by itself. NULL and empty texts have no windows and get a score, too; repeated rows and
    rows with a NULL id are scored one by one; an empty table gives none.
    """
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    marked = docs.withColumn("__held_out", held)
    base = columns(marked, doc_id=doc_id, text=text, held_out="__held_out")
    schema = f"doc_id {kind_of(base, 'doc_id')}, held_out boolean, score double, predicted int"
    fields = arrow_table(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        limit = shared.value.settings.limit
        for b, s in score_batches(shared.value, batches):
            yield rows_of(fields, b.column(0), b.column(2), s, (s >= limit).astype(np.int32))

    return base.mapInArrow(work, schema)
