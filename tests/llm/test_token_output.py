import gc
import json
import zlib
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF
from fixtures import messy, messy_rows
from tokenizers import Tokenizer

from wattline.llm.catalog import QUERIES
from wattline.llm.common import slices
from wattline.llm.encoder import WordEncoder
from wattline.llm.packing import Schedule, pack, pieces
from wattline.llm.token_files import read_index, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_give_the_ids_of_the_text():
    coder = WordEncoder(PATH)
    texts = [r[1] or "" for r in messy_rows()] + [
        "It's we'll I'M they'RE 'tis", "a.b c... d.. (e) 1,234.5 x,, no.1 1.", " nbsp　wide em", "é combininǵ.", "ΣΑΣ ΟΔΟΣ. İstanbul",
        "<|ENDOFTEXT|> <|startoftext|>x", "\x1cfs\x1d \x85nel", "don't.", "A's.", "…", "?!", "a?!", "ǅ ﬁ ½", "ｆｕｌｌ", "﻿bom",
    ]
    ids, sizes = coder.encode([t.encode() for t in texts])
    at = 0
    for t, n in zip(texts, sizes):
        assert ids[at : at + n].tolist() == ids_of(t), t
        at += n
    coder.forget()
    assert coder.encode([])[0].tolist() == []


def test_files_round_trip(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, SF).collect()}
    start = 0
    for i, text in docs:
        ids = ids_of(text)
        assert tuple(got[i]) == (i, start, len(ids), crc(ids))
        start += len(ids)


def test_format_of_the_files(spark, folder):
    docs = messy(spark)
    index = write_token_files(docs.repartition(3), f"file://{folder}/out")
    assert read_index(f"file://{folder}/out") == json.loads(json.dumps(index))
    order, flat = [], []
    for p in index["parts"]:
        name = f"{urlparse(f'file://{folder}/out').path}/{p['name']}"
        ids, offsets = np.memmap(f"{name}.ids", "<u2", "r"), np.memmap(f"{name}.off", "<u8", "r")
        assert len(offsets) == p["docs"] + 1 and offsets[-1] == len(ids) == p["ids"] and p["first_id"] == len(flat) and p["first_doc"] == len(order)
        order += pa.ipc.open_file(f"{name}.doc").read_all().column(0).to_pylist()
        flat += ids.tolist()
    assert order == sorted(order, key=lambda x: (x is not None, x or 0)) and len(flat) == index["ids"]
    rows = sorted(read_token_files(spark, f"file://{folder}/out").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == order
    assert all(crc(flat[r.start : r.start + r.n_tokens]) == r.ids_crc32 for r in rows)


def test_pieces_hold_every_id_once(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_mixture_packing"](spark, SF).collect()
    ids = {i: ids_of(r.text) for i, r in docs.items()}
    total = sum(map(len, ids.values()))
    covered, filled = {i: np.zeros(len(x), int) for i, x in ids.items()}, {}
    share = {}
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and crc(own) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id][r.start : r.start + r.length] += 1
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
        key = (r.sequence_id, docs[r.doc_id].source)
        share[key] = share.get(key, 0) + r.length
    assert all((x == 1).all() for x in covered.values())
    assert sorted(filled) == list(range(-(-total // 2048)))
    for k, parts in filled.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == min(2048, total - 2048 * k)
    sources = {s: sum(len(ids[i]) for i, r in docs.items() if r.source == s) for s in {r.source for r in docs.values()}}
    for k in range(total // 2048):
        for s, n in sources.items():
            assert abs(share.get((k, s), 0) - 2048 * n / total) <= 2 * len(sources)


def test_sequences_follow_given_targets(spark):
    rows = [(i, " ".join(["word"] * 50), "ab"[i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = pack(docs, window=100, targets={"a": 3, "b": 1}).collect()
    share = {}
    for r in got:
        key = (r.sequence_id, "ab"[r.doc_id % 2])
        share[key] = share.get(key, 0) + r.length
    busy = [k for k in range(sum(51 for _ in rows) // 2 * 4 // 3 // 100 - 1)]
    assert all(abs(share[k, "a"] - 75) <= 1 and abs(share[k, "b"] - 25) <= 1 for k in busy)
    assert sum(r.length for r in got) == 200 * 51


def test_schedule_equals_serving_one_token_at_a_time():
    rng = np.random.default_rng(0)
    for trial in range(60):
        queues = int(rng.integers(1, 7))
        tokens = rng.integers(1, 700, queues)
        rates = rng.integers(1, 50, queues).astype(float) if trial % 2 else tokens.astype(float)
        s = Schedule(tokens.astype(np.int64), rates, int(rng.choice([16, 64, 7])))
        turns = sorted(((n + 1) / rates[q], q) for q in range(queues) for n in range(tokens[q]))
        for k in range(s.windows + 1):
            assert s.given(np.array([k]))[0].tolist() == np.bincount([q for _, q in turns[: k * s.window]], minlength=queues).tolist()
        queue, start, size = [], [], []
        for q in range(queues):
            at = 0
            while at < tokens[q]:
                n = min(int(rng.integers(1, 120)), int(tokens[q]) - at)
                queue, start, size, at = [*queue, q], [*start, at], [*size, n], at + n
        doc, _, length, window, offset = pieces(s, np.array(queue), np.array(start), np.array(size))
        places = [w * s.window + o + i for w, o, n in zip(window, offset, length) for i in range(n)]
        assert sorted(places) == list(range(tokens.sum()))
        assert (np.bincount(doc, length, len(size)) == size).all()


@pytest.mark.parametrize("total", [1, 2, 3, 5, 100])
def test_last_sequence_is_padded_to_a_power_of_two(spark, total):
    docs = spark.createDataFrame([(1, " ".join(["word"] * (total - 1)), "a")], "doc_id long, text string, source string")
    last = max(pack(docs, window=64).collect(), key=lambda r: r.sequence_id)
    rest = total % 64 or 64
    assert last.padded == 1 << (rest - 1).bit_length()


def test_only_unknown_words_are_learnt(monkeypatch):
    from tokenizers import Tokenizer
    from wattline.llm import encoder as words

    coder, learnt = words.WordEncoder(words.default_path()), []
    monkeypatch.setattr(coder, "learn", lambda new, learn=coder.learn: (learnt.append(sorted(new)), learn(new)))
    texts = ["", " lead, and trail \n", "lead and\x0b\x0c more", "Ünïcode ÀÉ, <|X|>FOO İstanbul ÇA,ça", "\t", "lead"]
    plain = Tokenizer.from_file(words.default_path())
    for batch in (texts[:2], texts[2:], []):
        ids, sizes = coder.encode([t.encode() for t in batch])
        want = [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in batch]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
    assert learnt[0] == [b"and", b"lead,", b"trail"] and b"and" not in learnt[1] and b"lead" not in learnt[1]


def test_a_worker_lets_go_of_the_encoder_when_another_stage_begins(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(8)], "doc_id long, text string")
    pack(docs, source=None).collect()

    def left(batches):
        for b in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array([sum(isinstance(x, WordEncoder) for x in gc.get_objects())])], ["n"])

    assert {r.n for r in docs.repartition(8).mapInArrow(left, "n long").collect()} == {0}
