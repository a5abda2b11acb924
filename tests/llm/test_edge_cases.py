"""NULLs in any column, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from collections import Counter

import pytest
from fixtures import messy, messy_rows
from pyspark.sql import functions as F

from wattline.llm import language, suffix_tree
from wattline.llm.common import remainder
from wattline.llm.edit_counts import edited_counts, redactions
from wattline.llm.hash_index import exact_duplicates
from wattline.llm.line_dedup import deduplicated_lines, line_stage
from wattline.llm.mixing import mix, mixed_copies
from wattline.llm.ngram_join import link_components, one_of_each
from wattline.llm.packing import pack
from wattline.llm.quality import compression_bands, quality_stage
from wattline.llm.token_files import token_table


def predicted(docs):
    held = remainder(F.col("doc_id"), 4) == 2
    return language.predict(docs, language.fit(docs.where(~held), "doc_id", "text", "lang"), held_out=held)


BY_ROW = {
    "suffix_tree": lambda d: suffix_tree.suffix_tree_scores(d, remainder(F.col("doc_id"), 5) == 1),
    "ngram_join": lambda d: link_components(d, k=3, percent=90),
    "mixing": mix,
    "quality": compression_bands,
    "hash_index": exact_duplicates,
    "edit_counts": lambda d: edited_counts(d, redactions),
    "line_dedup": deduplicated_lines,
    "language": predicted,
    "token_files": token_table,
}
STAGES = {"quality": quality_stage, "lines": line_stage, "one_of_each": one_of_each, "mixed_copies": mixed_copies}


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_row(spark, name):
    got = BY_ROW[name](messy(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in messy_rows())


@pytest.mark.parametrize("name", BY_ROW)
def test_empty_table(spark, name):
    assert BY_ROW[name](messy(spark, [])).collect() == []


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_the_columns(spark, name):
    docs = messy(spark)
    got = STAGES[name](docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} <= {r[0] for r in messy_rows()}
    assert STAGES[name](messy(spark, [])).collect() == []


def test_packing_of_messy_rows(spark):
    rows = pack(messy(spark), window=64).collect()
    ids = Counter()
    for r in rows:
        ids[r.doc_id] += r.length
    whole = Counter()
    for r in token_table(messy(spark)).collect():
        whole[r.doc_id] += r.n_tokens
    assert ids == whole
    assert pack(messy(spark, [])).collect() == []


def test_only_null_texts(spark):
    rows = [(1, None, None, None, None), (None, None, None, None, None)]
    for name, f in BY_ROW.items():
        assert f(messy(spark, rows)).count() == 2, name
