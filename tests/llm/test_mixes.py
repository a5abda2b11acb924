import math
from collections import defaultdict

import pytest
from conftest import SF

from wattline.llm.catalog import QUERIES
from wattline.llm.mixing import mix, mixed_copies, targets_of


def test_targets_share_what_is_over():
    sizes = {"a": 100, "b": 10, "c": 1000, None: 50}
    got = targets_of(sizes)  # weights 5, 2, 1, 5 of 1740; caps 200, 20, 2000, 100
    assert got == pytest.approx({"a": 200, "b": 20, "c": 1420, None: 100})
    assert sum(got.values()) == pytest.approx(1.5 * 1160)
    even = targets_of({f"s{i}": 1000 for i in range(6)}, cap=10)
    assert list(even.values()) == pytest.approx([9000 * w / 16 for w in (5, 2, 1, 5, 2, 1)])
    assert targets_of({}) == {} and targets_of({"a": 0, None: 0}) == {"a": 0, None: 0}


@pytest.fixture(scope="module")
def mixed(spark):
    return QUERIES["op3_entropy_balancing"](spark, "/root/testdata/sf0.01").collect()


def test_sizes_and_targets(spark, mixed):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    source = defaultdict(int)
    for r in docs.values():
        source[r.source] += len((r.text or "").encode().split())
    want = targets_of(source)
    assert len(mixed) == len(docs)
    for r in mixed:
        assert r["size"] == len(docs[r.doc_id].text.encode().split()) and r.source_size == source[r.source]
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.copies * r["size"] and 0 <= r.taken <= 2 * r["size"]


def test_rates_are_the_tilt_that_meets_the_target(mixed):
    by = defaultdict(list)
    for r in mixed:
        by[r.source].append(r)
    for rows in by.values():
        assert sum(r.rate * r["size"] for r in rows) == pytest.approx(rows[0].target, rel=1e-5)
        slopes = {round(math.log(r.rate) / r["size"], 7) for r in rows if r.rate < 2 and r["size"] > 200}
        assert len(slopes) <= 1
        taken = sum(r.taken for r in rows)
        assert abs(taken - rows[0].target) <= max(r["size"] for r in rows)
        assert abs(sum(r.copies for r in rows) - sum(r.rate for r in rows)) <= 1


def test_many_documents_of_one_size_are_numbered_in_parts(spark):
    rows = [(i, "w " * (3 if i % 3 else i % 50), None if i % 2 else "s") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for per_group in (10, 65_536):
        by = defaultdict(list)
        for r in mix(docs, share=0.7, per_group=per_group).collect():
            by[r.source].append(r)
        for found in by.values():
            assert abs(sum(r.taken for r in found) - found[0].target) <= max(r["size"] for r in found)
            assert abs(sum(r.copies for r in found) - sum(r.rate for r in found)) <= 1


def test_reruns_agree(spark, mixed):
    again = mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in mixed)


def test_documents_are_repeated_with_their_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((r.doc_id, r.copies) for r in mix(docs).collect() if r.copies)
    out = mixed_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r["count"]) for r in out.groupBy("doc_id").count().collect()) == want


def test_own_targets_and_cap(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 40)), "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs, targets={"a": 1000.0, "b": 0.0}, cap=3.0).collect()
    assert sum(r.taken for r in got if r.source == "b") == 0
    assert abs(sum(r.taken for r in got if r.source == "a") - 1000) <= 40
