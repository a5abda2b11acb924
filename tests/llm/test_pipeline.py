import corpus_pipeline
import pytest
from conftest import SF
from test_hash_indexes import lower
from test_ngram_joins import plain_components
from test_quality_rules import plain


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage reads, and at the end what the last returns."""
    from wattline.llm.common import stored

    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_all_but_the_last_keep_the_columns(stages):
    assert all(d.columns == stages[0].columns and d.dtypes == stages[0].dtypes for d in stages[1:-1])
    assert [d.count() > 0 for d in stages] == [True] * 6


def test_quality_keeps_what_passes(stages):
    want = sorted(r.doc_id for r in stages[0].collect() if plain(r.text)[-1])
    assert sorted(r.doc_id for r in stages[1].collect()) == want


def test_lines_change_texts_only(stages):
    before = {r.doc_id: r for r in stages[1].collect()}
    after = {r.doc_id: r for r in stages[2].collect()}
    assert after.keys() <= before.keys()
    assert all(r.source == before[i].source and r.n_chars == len(r.text) and len(r.text) <= len(before[i].text) for i, r in after.items())
    seen = {lower(before[i].text) for i in after}
    assert all(lower(before[i].text) in seen or i in after for i in before) or len(after) < len(before)


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    group = {i: c for i, _, c in plain_components(rows, 5, 80)}
    kept = [group[r.doc_id] for r in stages[3].collect()]
    assert sorted(kept) == sorted(set(group.values()))


def test_mix_is_packed_whole(stages):
    from wattline.llm.token_files import token_table

    want = sorted((r.doc_id, r.n_tokens) for r in token_table(stages[4]).collect())
    pieces = stages[5].groupBy("doc_id").sum("length").collect()
    total = {}
    for i, n in want:
        total[i] = total.get(i, 0) + n
    assert {r.doc_id: r["sum(length)"] for r in pieces} == total


def test_run_gives_the_same(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() > 0.9 * stages[5].count()
