"""Token counts that follow edits: per document a segment tree over its pre-tokens, of which edits change a few leaves."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm.common import arrow_table, columns, kind_of, rows_of, slices

#: The pre-token pattern of the byte-level vocabularies. A match reads at most two characters beyond its own.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
AHEAD = 2
REMEMBERED = 300_000

#: (at, drop, put): at a character of the text as earlier edits left it, drop so many characters, put a text there.
Edit = tuple[int, int, str]

MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
NUMBER = r"\+?\d[\d ()./-]{5,}\d"
PERSONAL = re.compile(f"(?P<mail>{MAIL})|(?P<number>{NUMBER})")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def redactions(text: str) -> list[Edit]:
    """Edits that replace mail addresses and long numbers by a placeholder, from the last to the first."""
    found = [(m.start(), m.end() - m.start(), f"<{m.lastgroup}>") for m in PERSONAL.finditer(text)]
    return found[::-1]


class PieceCounts(dict):
    """Tokens of each pre-token, remembered."""

    def __init__(self, path: str, pattern: str = PATTERN):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split = regex.compile(pattern).findall

    def __missing__(self, piece: str) -> int:
        return self.learn([piece]) or self[piece]

    def learn(self, pieces: Iterable[str]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self]
        for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self[p] = len(e.ids)

    def of(self, pieces: list[str]) -> list[int]:
        self.learn(pieces)
        return [self[p] for p in pieces]


class CountTree:
    """Sums of tokens and characters over a document's pre-tokens; a leaf is a run of them, one at first."""

    def __init__(self, text: str, counts: PieceCounts):
        self.counts = counts
        self.leaves = counts.split(text) or [""]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.width), np.int64)
        at = self.width + np.arange(len(self.leaves))
        self.sums[0, at] = counts.of(self.leaves) if text else 0
        self.sums[1, at] = [len(x) for x in self.leaves]
        level = self.width
        while level > 1:
            half = level // 2
            self.sums[:, half:level] = self.sums[:, level : 2 * level : 2] + self.sums[:, level + 1 : 2 * level : 2]
            level = half
        self.encoded = 0

    @property
    def tokens(self) -> int:
        return int(self.sums[0, 1])

    @property
    def characters(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf with that character, or the last one, and the characters before it."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at - before >= self.sums[1, node] and self.sums[1, node + 1]:
                before += int(self.sums[1, node])
                node += 1
        return min(node - self.width, len(self.leaves) - 1), before

    def put(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = self.width + leaf
        change = np.array([tokens - self.sums[0, node], len(text) - self.sums[1, node]])
        while node:
            self.sums[:, node] += change
            node //= 2

    def apply(self, at: int, drop: int, put: str) -> None:
        """Change the text and count again only the leaves touched, those before that end within AHEAD characters of the
        change, and those after up to the first old boundary at which the new pre-tokens also break."""
        at = max(0, min(at, self.characters))
        drop = max(0, min(drop, self.characters - at))
        first, before = self.find(max(0, at - AHEAD - 1)) if at else (0, 0)
        last, begin = self.find(at + drop)
        end = begin + len(self.leaves[last])
        old = "".join(self.leaves[first : last + 1])
        new = old[: at - before] + put + old[at - before + drop :]
        while True:
            pieces = self.counts.split(new)
            breaks, place = set(), 0
            for p in pieces:
                place += len(p)
                breaks.add(place)
            whole = end == self.characters
            shift = len(put) - drop
            # the last leaf's end is an old boundary; what is before it has been matched with enough text behind it
            if whole or (end + shift - before) in breaks and end >= at + drop + AHEAD and self.same_behind(pieces, last):
                break
            last += 1
            new += self.leaves[last]
            end += len(self.leaves[last])
        tokens = sum(self.counts.of(pieces))
        self.encoded += len(pieces)
        self.put(first, new, tokens if new else 0)
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self.put(leaf, "", 0)

    def same_behind(self, pieces: list[str], last: int) -> bool:
        """Whether the pieces stay as they are with the next characters behind them."""
        behind, leaf = "", last + 1
        while len(behind) <= AHEAD and leaf < len(self.leaves):
            behind += self.leaves[leaf]
            leaf += 1
        kept = self.counts.split("".join(pieces) + behind[: AHEAD + 1])
        return kept[: len(pieces)] == pieces


def edited_counts(docs: DataFrame, edits: str | Callable[[str], list[Edit]], doc_id: str = "doc_id", text: str = "text", path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """One row per document: n_pieces (pre-tokens), n_tokens of the whole text, n_edits, n_encoded (pre-tokens encoded
    again for the edits) and n_tokens_after.

    `edits`: a column of array<struct<at, drop, put>>, or a function of the text; applied in order, each to the text as
    the earlier ones left it. Places outside the text are moved to its end; a NULL in an edit is 0 or "". A NULL text is
    empty; NULL or no edits leave the count. Rows are worked on one by one, without a shuffle; a tree is built for rows
    with edits only.
    """
    path = path or default_path()
    base = columns(docs, doc_id=doc_id, text=text, edits=None if callable(edits) else edits)
    if not callable(edits):
        base = base.withColumn("edits", F.transform("edits", lambda e: F.struct(e["at"].cast("long").alias("at"), e["drop"].cast("long").alias("drop"), e["put"].cast("string").alias("put"))))
    schema = f"doc_id {kind_of(base, 'doc_id')}, n_pieces long, n_tokens long, n_edits long, n_encoded long, n_tokens_after long"
    fields = arrow_table(schema)

    def work(batches):
        counts = PieceCounts(path, pattern)
        for b in slices(batches, 1):
            texts = [t or "" for t in b.column(1).to_pylist()]
            split = [counts.split(t) for t in texts]
            counts.learn(p for s in split for p in s)
            rows = []
            given = [edits(t) for t in texts] if callable(edits) else [[((e or {}).get("at") or 0, (e or {}).get("drop") or 0, (e or {}).get("put") or "") for e in x or []] for x in b.column(2).to_pylist()]
            for t, pieces, own in zip(texts, split, given):
                n = sum(map(counts.__getitem__, pieces))
                if own:
                    tree = CountTree(t, counts)
                    for e in own:
                        tree.apply(*e)
                    rows.append((len(pieces), n, len(own), tree.encoded, tree.tokens))
                else:
                    rows.append((len(pieces), n, 0, 0, n))
            yield rows_of(fields, b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(5)))

    return base.mapInArrow(work, schema)
