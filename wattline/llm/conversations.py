"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation's rows, in order, are kept, given another role, deleted, or get an empty turn before them, so that the
role initials read `(s?(ua)+)?`. A Viterbi search walks the rows once with four states (nothing yet, after the system
row, after a user row, after an assistant row). Back pointers form a tree with reference counts: once all surviving
states share an ancestor, the edits up to there are given out and forgotten. What stays in memory are the rows on which
the survivors differ.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import arrow_table, columns, kind_of, rows_of, stored

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

#: States of the search, by the last initial that was given out.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NO_PATH = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: state -> state by the initial that follows it.
NEXT = {
    "s": {NOTHING: SYSTEM},
    "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: The state after an inserted turn.
INSERTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Insertions that end a conversation.
TAIL = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: SPARE[y][x]: whatever follows x, y can follow it up for so much more: by inserted turns, by deleting a system row
#: that only an empty conversation may keep, or (0) because it may be followed by all that x may.
SPARE = {
    NOTHING: {SYSTEM: 0, USER: 5, ASSISTANT: 0},
    SYSTEM: {NOTHING: 10, USER: 5, ASSISTANT: 10},
    USER: {NOTHING: 7, SYSTEM: 5, ASSISTANT: 5},
    ASSISTANT: {NOTHING: 2, SYSTEM: 0, USER: 5},
}


def moves(initial: str, fault: str | None) -> dict[int, list[tuple[int, int, str]]]:
    """For each state after a row, the ways there: (state before it, cost, edits).

    A turn is inserted before a row that stays, never before one that is deleted: the same edits the other way round
    cost as much and come first in ASCII order. Two turns in a row lead back to where they began.
    """
    out = {y: [(y, DELETE, "D")] for y in range(4)}
    if fault in ("blank", "duplicate"):
        return out
    extra = TRUNCATED if fault == "truncated" else 0
    for to in "sua":
        if to != initial and to == "s":
            continue
        edit, cost = ("K", KEEP + extra) if to == initial else ("R", REROLE + extra)
        for x in range(4):
            if x in NEXT[to]:
                out[NEXT[to][x]].append((x, cost, edit))
            if INSERTED[x] in NEXT[to]:
                out[NEXT[to][INSERTED[x]]].append((x, cost + INSERT, "I" + edit))
    return out


class Survivors:
    """The search over the rows of one conversation.

    `cost` and `rank` belong to the best edits that lead to each state; rank compares their whole strings in ASCII
    order. Two such strings have as many letters K, R and D and end with one, so neither begins with the other, and
    comparing the ranks of what they extend, then the new letters, compares complete strings whatever their length.
    Costs count from the least, so that (cost, rank) takes few values: a step with its pruning is worked out once.
    """

    known: dict = {}

    def __init__(self):
        self.state = ((0, NO_PATH, NO_PATH, NO_PATH), (0, 0, 0, 0))
        self.spent = 0
        self.open: deque = deque()  # (row, moves by state, references by state, states alive)

    @classmethod
    def step(cls, state, kind):
        found = cls.known.get((state, kind))
        if found is None:
            (costs, ranks), ways, best = state, moves(*kind), {}
            for y in range(4):
                by = [(costs[x] + c, ranks[x], edits, x) for x, c, edits in ways[y] if costs[x] < NO_PATH]
                if by:
                    best[y] = min(by)
            # a state that another one surely undercuts is given up
            best = {y: b for y, b in best.items() if not any(z != y and best[z][0] + SPARE[z][y] < b[0] for z in best)}
            order = {y: i for i, y in enumerate(sorted(best, key=lambda y: best[y][1:3]))}
            least = min(b[0] for b in best.values())
            after = tuple(best[y][0] - least if y in best else NO_PATH for y in range(4)), tuple(order.get(y, 0) for y in range(4))
            found = after, least, tuple((best[y][3], best[y][2]) if y in best else None for y in range(4))
            if len(cls.known) > 100_000:
                cls.known.clear()
            cls.known[state, kind] = found
        return found

    def add(self, row: int, initial: str, fault: str | None) -> Iterator[tuple[int, str, int]]:
        """One more row; gives out (row, edits, state after it) of rows that all survivors share."""
        self.state, least, back = self.step(self.state, (initial, fault))
        self.spent += least
        if self.open:
            used = [0, 0, 0, 0]
            for b in back:
                if b:
                    used[b[0]] += 1
            last = self.open[-1]
            for y in range(4):
                if last[2][y]:
                    last[2][y] = used[y]
                    if not used[y]:
                        self.release(len(self.open) - 1, y)
        refs = [int(b is not None) for b in back]
        self.open.append([row, back, refs, sum(refs)])
        yield from self.shared()

    def release(self, at: int, y: int) -> None:
        """State y of a layer has lost its last reference; so may the states that it came from."""
        while True:
            layer = self.open[at]
            layer[3] -= 1
            if not at:
                return
            x, at = layer[1][y][0], at - 1
            self.open[at][2][x] -= 1
            if self.open[at][2][x]:
                return
            y = x

    def shared(self) -> Iterator[tuple[int, str, int]]:
        while self.open and self.open[0][3] == 1:
            row, back, refs, _ = self.open.popleft()
            y = next(i for i in range(4) if refs[i])
            yield row, back[y][1], y

    def end(self) -> tuple[int, str, int, list[tuple[int, str, int]]]:
        """Total cost, the insertions at the end, the state before them, and the edits that are left."""
        costs, ranks = self.state
        cost, _, tail, y = min((costs[y] + INSERT * len(TAIL[y]), ranks[y], TAIL[y], y) for y in range(4) if costs[y] < NO_PATH)
        left, at = [], y
        for row, back, _, _ in reversed(self.open):
            left.append((row, back[at][1], at))
            at = back[at][0]
        return self.spent + cost, tail, y, left[::-1]


def faulty_rows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, at (1, 2, … in a conversation), turn, role, text, fault (`blank`, `duplicate`, `truncated` or NULL),
    new_turn and illegal (0 or 1), stored as a table.

    Order: turn (NULL first), then role and text, so that repeated rows are neighbours. NULL roles and texts count as one space; rows with
    a NULL conv_id make up one conversation. Illegal: the initials of a row and the row before it are not su, ua or au.
    """
    base = columns(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    base = base.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    initial = F.substring("role", 1, 1)
    walked = base.withColumns({
        "at": F.row_number().over(order),
        "_turn": F.lag("turn").over(order),
        "_before": F.lag(initial).over(order),
    })
    trimmed = F.rtrim("text", F.lit(SPACE))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("at")) > 1
    fault = F.when(trimmed == "", "blank").when(again, "duplicate").when(~F.substring(trimmed, -1, 1).isin(*ENDS), "truncated")
    return stored(
        walked.select(
            "conv_id", "at", "turn", "role", "text", fault.alias("fault"),
            (F.col("turn").isNotNull() & ~F.col("_turn").eqNullSafe(F.col("turn"))).cast("long").alias("new_turn"),
            F.coalesce(~F.concat("_before", initial).isin("su", "ua", "au"), F.lit(False)).cast("long").alias("illegal"),
        ),
        "turns",
    )


def edits(rows: DataFrame) -> DataFrame:
    """conv_id, at, edits, state, of `faulty_rows`: the cheapest edits of each row, ties ASCII-least over the whole
    conversation; insertions at its end have a row of their own after the last.

    Only initials and faults are walked, in order, a conversation by one task, in memory bounded by what is undecided.
    """
    light = rows.select("conv_id", "at", F.substring("role", 1, 1).alias("initial"), "fault")
    schema = f"conv_id {kind_of(rows, 'conv_id')}, at int, edits string, state int"
    fields = arrow_table(schema)

    def work(batches):
        conv, search, last = None, None, 0
        out: list[tuple] = []

        def closed():
            _, tail, y, left = search.end()
            out.extend((conv, *x) for x in left)
            if tail:
                out.append((conv, last + 1, tail, y))

        for b in batches:
            for c, at, initial, fault in zip(*(col.to_pylist() for col in b.columns)):
                if search is None or at == 1:
                    if search is not None:
                        closed()
                    conv, search = c, Survivors()
                last = at
                out.extend((c, *x) for x in search.add(at, initial, fault))
            if out:
                yield rows_of(fields, *zip(*out))
                out.clear()
        if search is not None:
            closed()
            if out:
                yield rows_of(fields, *zip(*out))

    return light.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(work, schema)


def matched(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """left with the other columns of right, joined by equal names, NULL with NULL."""
    same: Column = F.lit(True)
    for n in names:
        same = same & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    more = [F.col(f"r.{c}") for c in right.columns if c not in names]
    return left.alias("l").join(right.alias("r"), same, "left").select("l.*", *more)


def repaired(turns: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `faulty_rows`, and the repaired conversations: conv_id, at, sub, edit, role, text, cost.

    (at, sub) is the order. edit: `K`ept, `R`eroled, `D`eleted (still listed) or `I`nserted (with an empty text); cost is
    the edit's, with what a truncated row costs that stays.
    """
    rows = faulty_rows(turns, **names)
    found = stored(edits(rows), "edits")
    joined = matched(found, rows.select("conv_id", "at", "role", "text", "fault"), "conv_id", "at")
    named = F.when(F.col("state") == USER, "user").otherwise("assistant")
    other = F.when(F.col("state") == USER, "assistant").otherwise("user")
    edit = F.substring("edits", -1, 1)
    item = lambda sub, kind, role, text, cost: F.struct(
        F.lit(sub).alias("sub"), kind.alias("edit"), role.alias("role"), text.alias("text"), cost.cast("long").alias("cost")
    )
    insert = lambda sub, role: item(sub, F.lit("I"), role, F.lit(""), F.lit(INSERT))
    own = F.when(edit == "D", DELETE).otherwise(F.when(edit == "R", REROLE).otherwise(KEEP) + F.when(F.col("fault") == "truncated", TRUNCATED).otherwise(0))
    stays = item(2, edit, F.when(edit == "R", named).otherwise(F.col("role")), F.col("text"), own)
    parts = (
        F.when(F.col("edits") == "II", F.array(insert(0, F.lit("user")), insert(1, F.lit("assistant"))))
        .when(F.col("edits") == "I", F.array(insert(0, F.lit("assistant"))))
        .when(F.col("edits").startswith("I"), F.array(insert(0, other), stays))
        .otherwise(F.array(stays))
    )
    return rows, joined.select("conv_id", "at", F.inline(parts))


def conversation_table(turns: DataFrame, every: DataFrame | None = None, **names: str) -> DataFrame:
    """A row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    gaps: turns missing between the least and the greatest, NULLs aside. audit: the edits in order. repaired_sha256: of
    the repaired `role:text`, joined by newlines; it reads a conversation's rows in order without holding them.
    `every`: further conversations (a column conv_id); those without rows have zeros, an empty audit and the hash of
    nothing.
    """
    rows, after = repaired(turns, **names)
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.sum("new_turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.sum("illegal").alias("illegal"),
    )
    schema = f"conv_id {kind_of(rows, 'conv_id')}, cost long, audit string, repaired_sha256 string"
    fields = arrow_table(schema)

    def work(batches):
        conv, began, digest, cost, audit, any_text = None, False, None, 0, [], False
        out: list[tuple] = []
        for b in batches:
            for c, edit, role, text, spent in zip(*(col.to_pylist() for col in b.columns)):
                if not began or c != conv:
                    if began:
                        out.append((conv, cost, "".join(audit), digest.hexdigest()))
                    conv, began, digest, cost, audit, any_text = c, True, hashlib.sha256(), 0, [], False
                cost += spent
                audit.append(edit)
                if edit != "D":
                    digest.update(("\n" * any_text + f"{role}:{text}").encode())
                    any_text = True
            if out:
                yield rows_of(fields, *zip(*out))
                out.clear()
        if began:
            yield rows_of(fields, *zip(*[(conv, cost, "".join(audit), digest.hexdigest())]))

    light = after.select("conv_id", "edit", "role", F.when(F.col("edit") != "D", F.col("text")).alias("text"), "cost", "at", "sub")
    ordered = light.repartition("conv_id").sortWithinPartitions("conv_id", "at", "sub").drop("at", "sub")
    digests = ordered.mapInArrow(work, schema)
    known = counts.select("conv_id") if every is None else every.select("conv_id").distinct()
    whole = matched(matched(known, counts, "conv_id"), digests, "conv_id")
    empty = hashlib.sha256().hexdigest()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with faults made by the checksum of `conv_id:turn`, modulo 20: 0 drops the row, 1 empties its text, 2 takes
    the ends of its sentences, 3 repeats it, 4 makes it a user's. NULLs count as one space, but for conv_id and turn
    themselves."""
    base = columns(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role_, text_ = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return base.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(role_).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text_, ENDS, "")).otherwise(text_).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
