import hashlib
import random
from collections import defaultdict

import numpy as np
from conftest import SF
from fixtures import messy, messy_rows

from wattline.llm import hash_index
from wattline.llm.catalog import QUERIES
from wattline.llm.hash_index import build_index, entries, exact_duplicates, grown


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            now = i == keep and not kept
            kept |= now
            out.append((i, keep, len(ids), now, hashlib.sha256(t).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_plain_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in QUERIES["op5_extendible_hash"](spark, SF).collect()), key=str) == plain([tuple(r) for r in docs])


def test_messy_rows_and_many_buckets(spark):
    got = exact_duplicates(messy(spark), capacity=300).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain([r[:2] for r in messy_rows()])


def test_collisions_are_chained(spark, monkeypatch):
    """All keys equal: only the bytes tell texts apart."""
    monkeypatch.setattr(hash_index, "keys_of", lambda texts: np.full(len(texts), 5, np.int64))
    rows = [(i, f"text {i % 7}") for i in range(40)] + [(99, "alone")]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_the_directory_doubles_until_buckets_fit():
    rng = random.Random(4)
    for trial in range(60):
        most = rng.randint(0, 7)
        loads = np.array([rng.choice([0, 1, 5, 40]) for _ in range(1 << most)])
        d = grown(loads, 50)
        assert len(d.slots) == 1 << d.depth and d.depth == max(d.bits)
        for b, bits in enumerate(d.bits):
            slots = np.flatnonzero(d.slots == b)
            assert len(slots) == 1 << d.depth - bits and slots[-1] - slots[0] == len(slots) - 1
            width = len(loads) >> d.depth
            load = loads[slots[0] * width : (slots[-1] + 1) * width].sum()
            assert load <= 50 or bits == most
        keys = np.array([rng.getrandbits(64) for _ in range(50)], np.uint64)
        want = [d.slots[int(k) >> 64 - d.depth] if d.depth else 0 for k in keys]
        assert d.bucket(keys).tolist() == [int(x) for x in want]


def test_index_files_hold_each_repeated_text_once(spark):
    rows = [(i, f"some text {i % 30} " * 5) for i in range(90)] + [(1000 + i, f"alone {i}") for i in range(50)]
    base = spark.createDataFrame(rows, "doc_id long, text string")
    index, directory = build_index(base, entries(base), 1000, 1 << 12)
    got = index.collect()
    assert {r.text for r in got if r.group_size > 1} == {lower(f"some text {i} " * 5) for i in range(30)}
    assert all(r.bucket == directory.bucket(np.array([r.key], np.int64).view(np.uint64))[0] for r in got)
    assert len(set(r.bucket for r in got)) > 1
