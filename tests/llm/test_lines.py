import random

import numpy as np
from conftest import SF
from fixtures import prose

from wattline.llm.catalog import QUERIES
from wattline.llm.line_dedup import deduplicated_lines, fingerprints, line_stage, lines_of


def first_places(docs, words):
    """Of each line, whether a run of lines with so many words around it stands earlier; the runs seen."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines = lines_of((text or "").encode())[1]
        n = np.concatenate([[0], np.cumsum([len(x.split()) for x in lines])])
        covered = np.zeros(len(lines), bool)
        shortest = {(a, int(np.searchsorted(n, n[a] + words))) for a in range(len(lines))}
        shortest |= {(int(np.searchsorted(n, n[b] - words, "right")) - 1, b) for b in range(1, len(lines) + 1)}
        for a, b in sorted(shortest):
            if 0 <= a and b <= len(lines):
                run = tuple(lines[a:b])
                covered[a:b] |= run in seen
                seen.add(run)
        out[i] = covered
    return out


def check(docs, got):
    long, short = first_places(docs, 50), first_places(docs, 25)
    for i, text in docs:
        lines = lines_of((text or "").encode())[1]
        left = lines_of((got[i].text or "").encode())[1]
        assert len(left) == len(lines) - got[i].n_deleted
        assert long[i].sum() <= got[i].n_deleted <= short[i].sum(), i
        stays = iter(left)
        assert all(any(x == y for y in stays) for x, deleted in zip(lines, short[i]) if not deleted), i  # nothing new goes


def test_query_against_all_runs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(docs, {r.doc_id: r for r in QUERIES["op7_winnowed_lines"](spark, SF).collect()})


def test_planted_passages(spark):
    rng = random.Random(9)
    passages = [prose(rng, 60) for _ in range(4)] + ["\n".join(prose(rng, 6) for _ in range(11))]
    docs = []
    for i in range(60):
        parts = [prose(rng, rng.randint(5, 80)) + "." for _ in range(3)]
        parts.insert(rng.randint(0, 3), passages[i % 5] + ".")
        docs.append((i, rng.choice([" ", "\n"]).join(parts)))
    got = {r.doc_id: r for r in deduplicated_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    for i, _ in docs:
        assert (got[i].deleted_words >= 50) == (i >= 5), i
        core = lines_of(passages[i % 5].encode())[1][1:-1]
        assert i < 5 or not set(core) <= set(lines_of(got[i].text.encode())[1])


def test_repeats_within_a_document_and_short_ones(spark):
    rng = random.Random(2)
    block, short = "\n".join(prose(rng, 12) for _ in range(6)), prose(rng, 9)
    rows = [(1, f"{block}\nbetween\n{block}\n{short}\n{short}"), (2, short), (3, None), (4, f"{short}\nown words here")]
    got = {r.doc_id: r for r in deduplicated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text.strip() == f"{block}\nbetween\n{short}\n{short}"
    assert got[2].text == short and got[3].text is None and got[4].n_deleted == 0


def test_stage_drops_what_is_empty_and_keeps_the_rest(spark):
    rng = random.Random(4)
    body = prose(rng, 150)
    rows = [(1, body, "x"), (2, body, "x"), (3, None, None), (4, "", "y"), (5, body + "\nA line of its own.", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {r.doc_id: r for r in line_stage(docs).collect()}
    assert sorted(got) == [1, 3, 4, 5] and got[1].text == body and got[5].text == "A line of its own." and got[5].runs == "z"


def test_windows_select_their_least_gram():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(0, 40, 5)
        words = rng.integers(1, 12, sizes.sum()).astype(np.int32)
        hashes = rng.integers(0, 1 << 63, sizes.sum()).astype(np.uint64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        place, value = fingerprints(hashes, words, ends, 10, 25)
        chosen = set(place.tolist())
        n = np.concatenate([[0], np.cumsum(words)])
        for i in range(len(words)):
            stop = np.searchsorted(n, n[i] + 25)
            if stop <= ends[i]:
                inside = [g for g in range(i, stop) if np.searchsorted(n, n[g] + 10) <= stop]
                assert chosen & set(inside)
        # equal runs have equal grams wherever they stand
        again, other = fingerprints(np.concatenate([hashes[:1], hashes]), np.concatenate([words[:1], words]), np.concatenate([[1], ends + 1])[: len(words) + 1], 10, 25) if len(words) else (place, value)
        assert set(other.tolist()) == set(value.tolist())


def test_passages_around_a_frequent_line(spark):
    """The line stands first in a document without the passage that two later ones share."""
    rng = random.Random(13)

    def line(n):
        return " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))

    docs = []
    for i in range(0, 120, 3):
        common, own = line(30), line(30)
        docs += [(i, f"{line(40)}\n{common}\n{line(40)}"), *((i + j, f"{line(40)}\n{common}\n{own}\n{line(40)}") for j in (1, 2))]
    got = {r.doc_id: r.n_deleted for r in deduplicated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: 2 if i % 3 == 2 else 0 for i in range(120)}
