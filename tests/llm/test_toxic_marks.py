"""The toxic dictionary: rare and short words, words outside the sample, copies, and more marks than one part holds."""

import random
import string
from collections import Counter

import pyarrow as pa
import pytest
from fixtures import prose
from test_toxicity import BAD, text

from wattline.llm import toxicity
from wattline.llm.toxicity import MARK, Gains, Training, beginnings, rare_beginnings, window_of, words_of

RARE, SHORT, COPIED = "zarnivox", "zug", "plimforg"


@pytest.fixture(scope="module")
def tables(spark):
    """600 toxic and 1,800 ordinary texts; one toxic text in 75 has a rare word, one in 60 a short one, 30 are near copies."""
    rng = random.Random(5)
    toxic = [text(rng, 50, 3).decode() for _ in range(540)]
    for word, n in ((RARE, 8), (SHORT, 10)):
        toxic += [" ".join([prose(rng, 20), word, prose(rng, 20)]) for _ in range(n)]
    toxic += [text(rng, 50, 3).decode() for _ in range(12)]
    body = prose(rng, 60)
    toxic += [f"{body} {prose(rng, 2) if i % 6 == 0 else ''} {COPIED} {body} {rng.choice(BAD)}" for i in range(30)]
    rows = [(i, t, 1) for i, t in enumerate(toxic)] + [(1_000 + i, prose(rng, 50), 0) for i in range(1_800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def test_rare_words_outside_the_sample_are_marks_and_copies_are_not(spark, tables):
    model = toxicity.fit(*tables, settings=Training(rows=100))
    marks = MARK.findall(model.toxic)
    assert {b" zarni", b" zug \n"} < set(marks) and all((" " + w[:5]).encode() in marks for w in BAD)
    assert not any(m.startswith(b" plim") for m in marks)
    rng = random.Random(6)
    texts = [" ".join([prose(rng, 20), w, prose(rng, 20), w, prose(rng, 9)]) for w in (RARE, SHORT, "berthat")]
    found = {r.doc_id: r.score for r in toxicity.scores(spark.createDataFrame(enumerate(texts), "doc_id long, text string"), model).collect()}
    assert min(found[0], found[1]) > 0.7 > 0.1 > found[2]


def test_counts_are_given_out_in_parts_when_there_are_many(monkeypatch):
    rng = random.Random(9)
    batch = pa.RecordBatch.from_arrays([pa.array([prose(rng, 40) for _ in range(60)]), pa.array([i % 4 for i in range(60)])], ["text", "side"])

    def counts():
        out, parts = Counter(), 0
        for rows in toxicity.count_batches([batch], (6, 7, 8)):
            parts += 1
            for part, side, n, texts in zip(*rows):
                out[part, side, "n"] += n
                out[part, side, "texts"] += texts
        return out, parts

    whole, few = counts()
    assert sum(whole[b"", side, "texts"] for side in range(4)) == 60
    monkeypatch.setattr(toxicity, "HELD", 500)
    assert counts()[0] == whole and counts()[1] > few


def test_a_rare_beginning_of_few_texts():
    rng = random.Random(7)
    toxic = [toxicity.Counter(words_of(text(rng, 40, 2))) for _ in range(1_000)]
    ordinary = [toxicity.Counter(words_of(text(rng, 40))) for _ in range(4_000)]
    for t in toxic[:6]:
        t[b"quizzaciously"] += 1
    for t in toxic[:2]:
        t[b"abecedarian"] += 1
    marks = rare_beginnings(toxic, ordinary, Training())
    assert b" quizz" in marks and b" abece" not in marks


def test_no_mark_is_cut_however_many():
    rng = random.Random(8)
    words = {"".join(rng.choices(string.ascii_lowercase, k=rng.choice([3, 4, 5, 6, 9]))).encode() for _ in range(4_000)}
    marks = [window_of(w)[:6] for w in sorted(words, key=lambda w: w[::-1])]
    marks = list(dict.fromkeys(marks))
    toxic = b"".join(marks)
    assert MARK.findall(toxic) == marks and len(toxic) > 20_000
    ordinary = (" ".join(prose(rng, 800).split()).encode() + b" ")[: 1 << 13]
    gains = Gains(ordinary, toxic)
    assert sum(gains[w] >= 3 for w in words) >= 0.99 * len(words)
    assert max(gains[w] for w in words_of(prose(rng, 400).encode()) if beginnings(w, (6, 7, 8)).isdisjoint(marks)) < 3
    assert Gains(ordinary, b"")[b"anything"] == 0


def test_beginnings_of_short_words_and_of_none():
    assert beginnings(b"zug!", (6, 7)) == {b" zug \n", b" zug \n\n"}
    assert beginnings(b"--", (6, 7)) == beginnings(b"", (6, 7)) == set()
    assert beginnings(b"(longer", (6, 7, 8)) == {b" longe", b" longer", b" longer "}
