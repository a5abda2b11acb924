import random
from collections import defaultdict

import pytest
from conftest import SF

from wattline.llm import ngram_join
from wattline.llm.components import components
from wattline.llm.ngram_join import link_components, needed, one_of_each, pair_needed, prefix_size


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def plain_components(rows, k, percent):
    """All pairs, but for those whose sizes rule them out."""
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = sorted((i for i in range(len(sets)) if sets[i][1]), key=lambda i: len(sets[i][1]))
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            a, b = sets[i][1], sets[j][1]
            if 100 * len(a) < percent * len(b):
                break
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(sets)):
        least[find(i)].append(sets[i][0])
    return sorted((sets[i][0], len(sets[i][1]), min(least[find(i)])) for i in range(len(sets)))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_equal_all_pairs(spark, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in link_components(docs, k=k, percent=percent).collect())
    assert got == plain_components([tuple(r) for r in docs.select("doc_id", "text").collect()], k, percent)


def variants(seed=5, bases=3, copies=60):
    """Groups of edited copies: many near their base, some only near another copy, some near nothing; copies of copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([60, 110]))] + passage
        family = [base]
        for _ in range(copies):
            w = list(rng.choice(family))
            for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(at, rng.choice(vocabulary)), lambda: w.pop(at), lambda: w.insert(at, rng.choice(vocabulary))])()
            family.append(w)
        rows += [" ".join(w) for w in family]
    rows += [" ".join(passage + [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 60]))]) for _ in range(60)]
    rows += ["same short text", "Same Short text", "same", "", "  ", "two words", "two  words"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 50), (1, 100)])
def test_families_of_copies(spark, k, percent):
    rows = variants()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in link_components(docs, k=k, percent=percent).collect())
    assert got == plain_components(rows, k, percent)


def test_blocks_of_a_home(spark, monkeypatch):
    from wattline.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    rows = variants(seed=11)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in link_components(docs, k=3, percent=80).collect())
    assert got == plain_components(rows, 3, 80)


def test_prefixes_of_similar_sets_share_what_is_needed():
    rng = random.Random(3)
    for _ in range(3000):
        percent = rng.choice([50, 80, 90, 100])
        items = rng.sample(range(200), rng.randint(1, 60))
        other = [x for x in items if rng.random() > 0.12] + rng.sample(range(200, 240), rng.randint(0, 6))
        a, b = sorted(set(items)), sorted(set(other))
        common = len(set(a) & set(b))
        if b and 100 * common >= percent * (len(a) + len(b) - common):
            shared = len(set(a[: prefix_size(len(a), percent)]) & set(b[: prefix_size(len(b), percent)]))
            assert shared >= max(needed(len(a), percent), needed(len(b), percent), 1)
            assert shared >= pair_needed(len(a), len(b), percent)


def test_one_of_each_keeps_every_group(spark):
    rows = variants(seed=2)
    docs = spark.createDataFrame([(None if i % 50 == 0 else i, t) for i, t in rows], "doc_id long, text string")
    kept = one_of_each(docs, k=5, percent=80).collect()
    want = len({c for _, n, c in plain_components(rows, 5, 80)})
    assert len(kept) == want


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(i, 700 + (i + 1) % 20) for i in range(700, 720)] + [(3, 3)]
    links += [(-5, 4), (4, 9)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(500, 560), 500), **dict.fromkeys(range(700, 720), 700), -5: -5, 4: -5, 9: -5}
    assert got == want


@pytest.mark.parametrize("paired", [0, 3, 10_000])
def test_pairs_and_blocks_give_the_same(spark, monkeypatch, paired):
    from wattline.llm import ngram_join

    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    rows = variants(seed=21, bases=4, copies=45)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in link_components(docs, k=2, percent=70).collect())
    assert got == plain_components(rows, 2, 70)


def by_hash(n):
    """Words in the order of their shingles' hashes."""
    from wattline.llm.common import Hashes, shingles

    words = [f"h{i}" for i in range(n)]
    codes = shingles(Hashes().of([w.encode() for w in words]), 1).tolist()
    return [w for _, w in sorted(zip(codes, words))]


def apart(spark, parts):
    """The rows of each part, all of one length, in a task of its own, so that no task sees a shingle often and ranks it."""
    return spark.createDataFrame(spark.sparkContext.parallelize([r for p in parts for r in p], len(parts)), "doc_id long, text string")


@pytest.mark.parametrize("joined", [False, True])
def test_members_of_small_groups_that_differ_from_the_leader(spark, joined):
    """Triples with one prefix: the first differs from the others, which are similar; alone or beside a text that shares
    two shingles of their prefix."""
    words = by_hash(6000)
    front, back = iter(words[:1200]), iter(words[1200:])

    def some(side, n):
        return [next(side) for _ in range(n)]

    parts = [[] for _ in range(4)]
    for i in range(40):
        prefix, mine, theirs, last = some(front, 6), some(back, 14), some(back, 13), some(back, 2)
        parts[0].append((i, " ".join(prefix + mine)))
        parts[1].append((100 + i, " ".join(prefix + theirs + last[:1])))
        parts[2].append((200 + i, " ".join(prefix + theirs + last[1:])))
        if joined:
            parts[3].append((300 + i, " ".join(prefix[:2] + some(front, 4) + some(back, 14))))
    parts = [p for p in parts if p]
    got = sorted(tuple(r) for r in link_components(apart(spark, parts), k=1, percent=80).collect())
    want = plain_components([r for p in parts for r in p], 1, 80)
    assert sum(c != i for i, _, c in want) == 40
    assert got == want


def test_members_of_a_small_main_home(spark, monkeypatch):
    """Two similar texts of different prefixes share only shingles of more rows than are paired, and are both at the home
    of most of them, which is small."""
    from wattline.llm import ngram_join

    monkeypatch.setattr(ngram_join, "PAIRED", 4)
    words = by_hash(4000)
    common, front, back = words[1:5], iter(words[5:400]), iter(words[1000:])

    def some(side, n):
        return [next(side) for _ in range(n)]

    theirs = some(back, 14)
    rows = [common + some(front, 2) + (theirs if i in (1, 2) else some(back, 14)) for i in range(4)]
    rows += [words[:1] + common + some(front, 1) + some(back, 14) for _ in range(4)]
    parts = [[(i, " ".join(w))] for i, w in enumerate(rows)]
    got = sorted(tuple(r) for r in link_components(apart(spark, parts), k=1, percent=80).collect())
    want = plain_components([r for p in parts for r in p], 1, 80)
    assert sum(c != i for i, _, c in want) == 1
    assert got == want


def test_postings_are_shuffled_once_before_they_are_stored(spark, monkeypatch):
    plans = []

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.localCheckpoint()

    monkeypatch.setattr(ngram_join, "stored", stored)
    prefix = "gid long, n long, prefix array<long>"
    real = spark.createDataFrame([(1, 10, [1, 2, 3]), (2, 10, [1, 2, 9]), (2, 10, []), (3, 10, [7, 8, 9]), (1, 10, [1, 2, 3])], prefix)
    found = ngram_join.shared_postings(real, 90, 1 << 10)
    assert sorted(map(tuple, found.select("gid", "token").collect())) == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 9), (3, 9)]
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]
