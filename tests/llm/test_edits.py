import random

from conftest import SF

from wattline.llm.catalog import QUERIES
from wattline.llm.edit_counts import CountTree, PieceCounts, default_path, edited_counts, redactions

COUNTS = PieceCounts(default_path())
PARTS = ["a", "b", "e", "r", "s", "'", "  ", " ", "\n", "1", "2", ".", "é", "<|endoftext|>", "x ", "'re", "the ", " of", " is", "🙂", "\t"]


def whole(text):
    return len(COUNTS.tokenizer.encode(text, add_special_tokens=False).ids)


def test_any_edits_give_the_count_of_the_edited_text():
    rng = random.Random(1)
    for _ in range(800):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 40)))
        tree = CountTree(text, COUNTS)
        assert tree.tokens == whole(text)
        for _ in range(rng.randint(1, 8)):
            at, drop = rng.randint(0, len(text) + 1), rng.choice([0, 0, 1, 2, 5, 50])
            put = "".join(rng.choices(PARTS, k=rng.choice([0, 1, 2, 9])))
            at = min(at, len(text))
            text = text[:at] + put + text[at + drop :]
            tree.apply(at, drop, put)
            assert "".join(tree.leaves) == text and tree.characters == len(text)
            assert tree.tokens == whole(text)


def test_only_what_an_edit_touches_is_encoded_again():
    text = " ".join(f"word{i} and" for i in range(3000))
    tree = CountTree(text, COUNTS)
    tree.apply(15_000, 3, "xyz")
    assert 0 < tree.encoded < 12
    assert tree.tokens == whole(text[:15_000] + "xyz" + text[15_003:])


def edited(text):
    for at, drop, put in redactions(text):
        text = text[:at] + put + text[at + drop :]
    return text


def test_query_equals_counts_of_whole_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op6_edited_counts"](spark, SF).collect()
    assert len(got) == len(docs) and any(r.n_edits for r in got)
    for r in got:
        text = docs[r.doc_id] or ""
        assert (r.n_tokens, r.n_tokens_after, r.n_edits) == (whole(text), whole(edited(text)), len(redactions(text)))
        assert r.n_encoded <= 40 * r.n_edits


def test_edits_from_a_column(spark):
    rows = [(1, "hello world", [(0, 5, "bye"), (3, 0, "!")]), (2, "abc", None), (3, None, [(0, 0, "new"), (99, 4, " end")]), (4, "x", [(None, None, None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<at:int,drop:int,put:string>>")
    got = {r.doc_id: r for r in edited_counts(docs, "edits").collect()}
    assert [got[i].n_tokens_after for i in (1, 2, 3, 4)] == [whole("bye! world"), whole("abc"), whole("new end"), whole("x")]
