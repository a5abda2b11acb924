"""Conversation repair against an exhaustive search over whole strings of edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from conftest import SF
from pyspark.sql import functions as F

from wattline.llm.catalog import QUERIES
from wattline.llm.conversations import Survivors, conversation_table, damaged, repaired

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Cheapest first, then ASCII-least, over (cost, edits) of all prefixes; roles are kept as whole strings."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, out = heapq.heappop(queue)
        if (i, roles[-1:], "s" in roles) in done and not (i == len(rows) and LEGAL.fullmatch(roles)):
            continue
        if i == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit, out
        done.add((i, roles[-1:], "s" in roles))
        options = [("I", 5, r, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            options.append(("D", 2, "", None))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                options.append(("K", extra, role, (role, text)))
                options += [("R", 1 + extra, r, (r, text)) for r in ("user", "assistant")]
        for edit, more, role, row in options:
            if edit != "D" and not (role[:1] and re.fullmatch(r"(s?(ua)*u?)?", roles + role[:1])):
                continue
            heapq.heappush(queue, (cost + more, audit + edit, i + (edit != "I"), roles + role[:1] * (edit != "D"), out + ((row,) if row else ())))
    raise AssertionError


def brute(rows, faults):
    """All strings of edits whose cost is least, by dynamic programming over sets of whole strings."""
    best = {"": {(0, "", ())}}
    for (role, text), fault in [*zip(rows, faults), ((None, None), None)]:
        grown = dict(best)
        for _ in range(2):
            for roles, paths in list(grown.items()):
                for r in ("user", "assistant"):
                    if re.fullmatch(r"(s?(ua)*u?)?", roles + r[0]):
                        grown.setdefault(roles + r[0], set())
                        grown[roles + r[0]] = grown[roles + r[0]] | {(c + 5, a + "I", o + ((r, ""),)) for c, a, o in paths}
        if role is None:
            ends = [p for roles, paths in grown.items() if LEGAL.fullmatch(roles) for p in paths]
            return min(ends, key=lambda p: p[:2])
        after = {}
        for roles, paths in grown.items():
            ways = [("D", 2, "", None)]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                ways += [("K", extra, role, (role, text)), ("R", 1 + extra, "user", ("user", text)), ("R", 1 + extra, "assistant", ("assistant", text))]
            for edit, cost, new, row in ways:
                to = roles + new[:1]
                if edit == "D" or new[:1] and re.fullmatch(r"(s?(ua)*u?)?", to):
                    after.setdefault(to, set()).update((c + cost, a + edit, o + ((row,) if row else ())) for c, a, o in paths)
        # of equal role strings only the least goes on: what follows is the same for all
        best = {k: {min(v, key=lambda p: p[:2])} for k, v in after.items()}
    raise AssertionError


def plain_row(rows):
    turns = [t for t, _, _ in rows if t is not None]
    said = [(r, x) for _, r, x in rows]
    faults = plain_faults(said)
    cost, audit, out = brute(said, faults)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": illegal,
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    }


def plain_damage(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in by.items()}


def searched(rows, faults):
    search, got = Survivors(), []
    for i, ((role, _), fault) in enumerate(zip(rows, faults)):
        got += search.add(i + 1, role[:1], fault)
    cost, tail, _, left = search.end()
    return cost, "".join(e for _, e, _ in [*got, *left]) + tail


def test_search_equals_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", " "]), str(i)) for i in range(rng.randint(0, 9))]
        faults = [rng.choice([None, None, None, "truncated", "blank", "duplicate"]) for _ in rows]
        assert searched(rows, faults) == brute(rows, faults)[:2], (rows, faults)


def test_brute_force_agrees_with_a_search_by_cost():
    rng = random.Random(6)
    for _ in range(150):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), str(i)) for i in range(rng.randint(0, 5))]
        faults = [rng.choice([None, None, "truncated", "blank"]) for _ in rows]
        assert plain_repair(rows, faults)[:2] == brute(rows, faults)[:2]


def test_edits_are_given_out_as_survivors_meet():
    rng = random.Random(8)
    search, most = Survivors(), 0
    for i in range(20_000):
        role = ("user", "assistant")[i % 2] if rng.random() < 0.9 else rng.choice(["system", "user", "assistant"])
        for _ in search.add(i + 1, role[0], rng.choice([None] * 6 + ["blank", "truncated"])):
            pass
        most = max(most, len(search.open))
    assert most < 200


def test_undecided_rows_wait_for_the_end():
    rows = [("user", str(i)) for i in range(60)]
    assert searched(rows, [None] * 60) == brute(rows, [None] * 60)[:2]


def test_query_equals_brute_force(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r.conv_id: r.asDict() for r in QUERIES["op13_structure_repair"](spark, SF).collect()}
    by = plain_damage([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert got == {c: {"conv_id": c, **plain_row(r)} for c, r in by.items()}


MESSY = [
    (1, 0, "system", "s."), (1, 1, "user", "a."), (1, 1, "user", "a."), (1, 2, "assistant", "b"), (1, 5, None, "x."), (1, None, "user", "n."),
    (None, 0, "user", "q?"), (None, 1, "assistant", None), (None, None, None, None), (2, None, "assistant", "only."), (2, None, "user", " \t"),
    (3, 3, "tool", "z!"), (3, 4, "", "no role."), (4, 7, "user", "…"), (5, 1, "user", "same."), (5, 2, "user", "same."), (5, 3, "user", "same. \n"),
    (6, 1, "user", "x" * 300_000 + "."), (6, 2, "assistant", "." + " " * 300_000), (7, -3, "assistant", "a."), (7, 9_000_000_000, "user", "b."),
]


@pytest.mark.parametrize("by_damage", [False, True])
def test_awkward_rows(spark, by_damage):
    turns = spark.createDataFrame([r + ("x", "y") for r in MESSY], "conv_id long, turn long, role string, text string, at string, edits string")
    got = {r.conv_id: r.asDict() for r in conversation_table(damaged(turns) if by_damage else turns, every=turns).collect()}
    if by_damage:
        by = plain_damage(MESSY)
    else:
        by = {}
        for c, t, r, x in MESSY:
            by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
        by = {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in by.items()}
    assert got == {c: {"conv_id": c, **plain_row(r)} for c, r in by.items()}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_table(none).collect() == []
    some = spark.createDataFrame([(4,), (None,)], "conv_id long")
    rows = conversation_table(none, every=some).collect()
    assert {(r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in rows} == {(c, 0, "", hashlib.sha256(b"").hexdigest()) for c in (4, None)}


def test_repaired_rows(spark):
    turns = spark.createDataFrame([(1, 1, "assistant", "b."), (1, 2, "user", "c."), (1, 3, "user", "d.")], "conv_id long, turn long, role string, text string")
    _, after = repaired(turns)
    got = [(r.edit, r.role, r.text, r.cost) for r in after.orderBy("at", "sub").collect()]
    assert got == [("D", "assistant", "b.", 2), ("K", "user", "c.", 0), ("R", "assistant", "d.", 1)]
    assert after.agg(F.sum("cost")).first()[0] == 3
