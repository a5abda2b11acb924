"""Compression distance: held-out accuracy, the parts of the model, and awkward rows."""

import random
import zlib

import pytest
from conftest import SF
from fixtures import messy, messy_rows, prose
from pyspark.sql import functions as F

from wattline.llm import toxicity
from wattline.llm.catalog import QUERIES
from wattline.llm.toxicity import Gains, Training, dictionaries, fit_sample, words_of

BAD = ["vilkrat", "snorbel", "grumpfz", "quabbel"]


def text(rng, n, bad=0):
    words = prose(rng, n).split()
    for _ in range(bad):
        words[rng.randrange(n)] = rng.choice(BAD) + rng.choice(["", "s", "ing", ".", ", "])
    return " ".join(words).encode()


def samples(rng, n):
    return [text(rng, rng.randint(40, 300), rng.randint(3, 9)) for _ in range(n)], [text(rng, rng.randint(40, 300)) for _ in range(4 * n)]


@pytest.fixture(scope="module")
def model():
    return fit_sample(*samples(random.Random(1), 60))


def test_gain_of_marked_words_only(model):
    gains = Gains(model.ordinary, model.toxic)
    assert all(gains[w.encode() + end] >= 3 for w in BAD for end in (b"", b"ing", b"!"))
    words = {w for t in samples(random.Random(2), 30)[1] for w in words_of(t)}
    assert max(gains[w] for w in words) < 3
    assert gains[b""] < 3 and gains[b"x" * 100_000] < 3


def test_unseen_texts_are_told_apart(spark, model):
    toxic, ordinary = samples(random.Random(3), 100)
    rows = [(i, t.decode()) for i, t in enumerate(toxic + ordinary)]
    got = {r.doc_id: r for r in toxicity.scores(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert sum(got[i].predicted for i in range(100)) >= 98
    assert sum(got[i].predicted for i in range(100, 500)) == 0


def test_lengths_follow_the_dictionaries():
    rng = random.Random(4)
    toxic, ordinary = ([toxicity.Counter(words_of(t)) for t in x] for x in samples(rng, 40))
    trained, marks = dictionaries(toxic, ordinary, Training())
    assert len(trained) <= Training().ordinary_bytes
    assert all((" " + w[:4]).encode() in marks for w in BAD)
    assert not any(w[:5].encode() in trained for w in BAD)


def test_query_on_held_out_documents(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op12_compression_distance"](spark, sf).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got.keys() == docs.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[i].score, y) for i, y in labels.items() if got[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held for b, z in held if y > z]
    assert sum(pairs) / len(pairs) > 0.75
    assert sum(s >= 0.7 for s, y in held if not y) <= 0.02 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels, ~held) == toxicity.fit(docs, turned, ~held)


def test_awkward_rows(spark, model):
    rows = toxicity.scores(messy(spark), model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in messy_rows())
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scores(messy(spark, []), model).collect() == []


def test_few_or_no_labels(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None), (3, 0), (3, 1), (99, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        found = toxicity.fit(docs, some)
        assert not found.weights
        assert all(r.predicted == 0 and 0 <= r.score <= 1 for r in toxicity.scores(docs, found).collect())
    assert not toxicity.fit(messy(spark, []), labels).weights


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    small = toxicity.fit(docs, labels, settings=Training(rows=6, sample_bytes=1 << 14))
    assert small == toxicity.fit(docs.repartition(7), labels.repartition(3), settings=Training(rows=6, sample_bytes=1 << 14))
