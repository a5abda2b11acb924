"""Spelling variants against a comparison of all words with all words."""

import random
import re
import zlib
from collections import Counter

from conftest import SF
from fixtures import messy, messy_rows

from wattline.llm.catalog import QUERIES
from wattline.llm.spelling import RANGE, border_nodes, spelling_variants, trie_nodes, variants, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(counts):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] is not None else None) for w, n in counts.items()}


def by_word(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def awkward_counts():
    rng = random.Random(3)
    letters = "aabéÿ"
    counts = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))): rng.choice([3, 3, 6, 7, 12, 50]) for _ in range(500)}
    counts |= {"a" * 30_000: 3, "a" * 29_999: 6, "a" * 29_999 + "b": 12, "b" + "a" * 29_999: 12, "aaaaa": 40, "ÿ" * 6: 3, "÷×÷×÷": 3}
    chain = "zzzzz"
    for i in range(12):
        counts[chain + "y" * i] = 3 * 2**i
    return counts


def test_variants_equal_all_pairs(spark):
    counts = awkward_counts()
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    want = plain_variants(counts)
    assert by_word(variants(words)) == want
    assert by_word(variants(words, parts=37)) == want
    assert want["zzzzz"][1] == "zzzzz" + "y" * 11


def test_nodes_number_the_prefixes(spark):
    words = spark.createDataFrame([(w,) for w in awkward_counts() if len(w) < 100], "word string").repartition(3)
    for parts in (1, 6, 60):
        by_prefix, numbers = {}, {}
        for r in trie_nodes(words, parts).collect():
            numbers[r.word] = r.number
            assert len(r.nodes) == len(r.word) + 1
            for i, node in enumerate(r.nodes):
                assert by_prefix.setdefault(r.word[:i], node) == node
        assert len(set(by_prefix.values())) == len(by_prefix)
        assert sorted(numbers, key=numbers.get) == sorted(numbers)


def test_border_nodes():
    assert border_nodes([]) == []
    assert border_nodes(["ab", "abc", "b"]) == [[0, 1, 2], [0, 1, 2, 3], [0, 4]]
    assert RANGE > 10**12


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = plain_counts([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert by_word(QUERIES["op11_trie_pairs"](spark, SF)) == plain_variants(counts)


def test_awkward_documents(spark):
    rows = messy_rows() + [(50 + i, "naïve naïve NAÏVE naive coöp ×÷×÷× " * i, "en", None, None) for i in range(4)]
    rows += [(None, "x" * 40_000 + " " + "x" * 40_000, None, None, None)] * 2
    assert {r.word: r.n for r in word_counts(messy(spark, rows)).collect()} == plain_counts([r[:2] for r in rows])
    assert by_word(spelling_variants(messy(spark, rows))) == plain_variants(plain_counts([r[:2] for r in rows]))


def test_no_rows(spark):
    assert spelling_variants(messy(spark, [])).collect() == []
    assert spelling_variants(messy(spark, [(1, None, None, None, None), (2, "", None, None, None), (3, "one two", None, None, None)])).collect() == []
