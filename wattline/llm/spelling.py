"""Spelling variants: words that differ by one inserted, deleted or replaced character, by pairs of trie nodes.

The nodes of the trie of all words and of the trie of all reversed words are numbered. A word of length L has a hole at
each of its characters: the pair (node of what stands before, node of what follows). It has a gap at each of its L + 1
cuts: the pair of nodes on both sides. Two words with the same hole differ by a replaced character there; a word whose
hole is another word's gap has one character more. Every near pair meets in such a pair of integers and nothing else
does, so no candidate has to be verified.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import arrow_table, columns, lists_of, rows_of, slices, stored, utf8

#: UTF-8 of [A-Za-z] and of U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
#: Words that a task counts before it gives them out to be summed.
COUNTED = 500_000
#: Node numbers of a range of words begin at the range's number times this.
RANGE = 1 << 40


def misspelt(run: bytes, seed: int, one_in: int = 97) -> bytes:
    """The run without one of its characters if its checksum asks for it. seed: the checksum of what stands before."""
    h = zlib.crc32(run, seed)
    if h % one_in:
        return run
    chars = run.decode()
    at = h % len(chars)
    return (chars[:at] + chars[at + 1 :]).encode()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_n: int = 3) -> DataFrame:
    """word, n: words of whole texts, counted over all of them, as a stored table.

    Maximal runs of letters up to U+00FF, A-Z in lower case; the checksum of `<doc_id>:<run>` takes a character from one
    in 97. A NULL id counts as the empty text; NULL and empty texts have no words; repeated rows count again.
    """
    base = columns(docs, doc_id=doc_id, text=text).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    schema = "word string, n long"
    fields = arrow_table(schema)

    def given(counts):
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        batch = rows_of(fields, words, list(counts.values()))
        return batch.filter(pc.greater_equal(pc.utf8_length(words), least_length))

    def work(batches):
        total: Counter = Counter()
        for b in slices(batches, 1):
            for key, data in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                seed = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(RUN.findall(data.lower())).items():
                    total[misspelt(run, seed)] += n
            if len(total) > COUNTED:
                yield given(total)
                total.clear()
        if total:
            yield given(total)

    counted = base.mapInArrow(work, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= least_n), "words")


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def border_nodes(borders: list[str]) -> list[list[int]]:
    """Node numbers along each border, of the trie of all borders. They are in order; the root is 0."""
    out: list[list[int]] = []
    count, before = 0, ""
    for word in borders:
        n = shared_prefix(before, word) if out else 0
        path = out[-1][: n + 1] if out else [0]
        path = path + list(range(count + 1, count + 1 + len(word) - n))
        count += len(word) - n
        out.append(path)
        before = word
    return out


def trie_nodes(words: DataFrame, parts: int | None = None) -> DataFrame:
    """word, number, nodes: the numbers of a word's prefixes, the empty one and the word itself included.

    Distinct words are dealt out by ranges and read in order: a word adds the nodes that it doesn't share with the word
    before it. A prefix that begins words of two ranges begins the last word of the earlier one, too; these words, one
    for each range, go to all tasks and their prefixes have numbers of their own. `number` rises in code point order.
    """
    ranges = words.select("word").repartitionByRange(*([parts] if parts else []), "word")
    dealt = stored(ranges.withColumn("part", F.spark_partition_id()), "ranges")
    borders = sorted(r[0] for r in dealt.groupBy("part").agg(F.max("word")).select("max(word)").collect())
    shared = dealt.sparkSession.sparkContext.broadcast((borders, border_nodes(borders)))
    schema = "word string, number long, nodes array<long>"
    fields = arrow_table(schema)

    def work(batches):
        borders, paths = shared.value
        part, row, count, before, path = None, 0, 0, "", []
        for b in batches:
            out, lengths, numbers = [], [], []
            for p, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if p != part:
                    part, row, count, before, path = p, 0, 0, "", [0]
                at = bisect_left(borders, word)
                known, most = [0], 0
                for i in (at - 1, at):  # of all borders, those beside a word share most with it
                    if 0 <= i < len(borders) and (n := shared_prefix(borders[i], word)) >= most:
                        known, most = paths[i], n
                n = max(shared_prefix(before, word), most)
                base = (p + 1) * RANGE + count - n
                path = [*known[: most + 1], *path[most + 1 : n + 1], *range(base + n, base + len(word))]
                count += len(word) - n
                out.append(np.array(path, np.int64))
                lengths.append(len(path))
                numbers.append((p + 1) * RANGE + row)
                before, row = word, row + 1
            if out:
                yield rows_of(fields, b.column(1), numbers, lists_of(np.concatenate(out), np.array(lengths), pa.int64()))

    return dealt.select("part", "word").repartition("part").sortWithinPartitions("part", "word").mapInArrow(work, schema)


def pair_rows(numbered: DataFrame, parts: int | None = None) -> DataFrame:
    """a, b, number, n, hole, first: the pairs of nodes of every word (word, number, nodes, n), holes and gaps.

    A character that repeats can be taken out at several places with one result: `first` marks the first of such holes.
    """
    backward = trie_nodes(numbered.select(F.reverse("word").alias("word")), parts)
    backward = backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("after"))
    both = numbered.join(backward, "word").select("number", "n", "word", "nodes", "after")
    schema = "a long, b long, number long, n long, hole boolean, first boolean"
    fields = arrow_table(schema)

    def work(batches):
        for b in slices(batches, 2, 1 << 18):
            before, after = (b.column(i).flatten().to_numpy() for i in (3, 4))
            chars = np.frombuffer("".join(b.column(2).to_pylist()).encode("utf-32-le"), np.uint32)
            cuts = pc.list_value_length(b.column(3)).to_numpy().astype(np.int64)
            ends = np.cumsum(cuts)
            # the backward nodes count from the end of the word
            after = after[np.repeat(ends + ends - cuts, cuts) - 1 - np.arange(len(after))]
            is_last, is_first = np.zeros(len(before), bool), np.zeros(len(before), bool)
            is_last[ends - 1] = True
            is_first[ends - cuts] = True
            number, n = (np.repeat(b.column(i).to_numpy(), cuts) for i in (0, 1))
            first = np.concatenate([[True], chars[1:] != chars[:-1]]) | is_first[~is_last]
            yield rows_of(
                fields, np.concatenate([before[~is_last], before]), np.concatenate([after[~is_first], after]),
                np.concatenate([number[~is_last], number]), np.concatenate([n[~is_last], n]),
                np.repeat([True, False], [len(chars), len(before)]), np.concatenate([first, np.zeros(len(before), bool)]),
            )

    return both.mapInArrow(work, schema)


def near_words(pairs: DataFrame) -> DataFrame:
    """number, n_near, best (n and negative number of the near word of largest n, ties by code points) of `pair_rows`,
    for words that have near words.

    A pair of nodes has at most one word with that gap and as many with that hole as there are letters. Each counts
    the others; the best other one is the first of the pair's words, or the second for the first itself.
    """
    pair = Window.partitionBy("a", "b")
    ranked = pair.orderBy(F.col("n").desc(), "number")
    every = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    word = F.struct("n", (-F.col("number")).alias("number"))
    met = pairs.select(
        "number", "hole", "first",
        F.count(F.lit(1)).over(every).alias("all"),
        F.count(F.when(F.col("hole"), 1)).over(every).alias("holes"),
        F.count(F.when(F.col("first"), 1)).over(every).alias("firsts"),
        F.row_number().over(ranked).alias("at"),
        F.first(word).over(every).alias("one"),
        F.nth_value(word, 2).over(every).alias("two"),
    ).where("all > 1")
    gaps = F.when(F.col("first"), F.col("all") - F.col("holes")).otherwise(0)
    links = F.when(F.col("hole"), F.col("holes") - 1 + gaps).otherwise(F.col("firsts"))
    other = F.when(F.col("at") == 1, F.col("two")).otherwise(F.col("one"))
    return met.select("number", links.alias("links"), other.alias("best")).groupBy("number").agg(
        F.sum("links").alias("n_near"), F.max("best").alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """number, root of the links (number, to), by doubling: each round follows the links of the links. A form is at least
    twice as frequent as its word, so there are no circles and a way has fewer than 64 links: six rounds at most."""
    out = stored(links.select("number", F.col("to").alias("root"), F.lit(True).alias("moved")), "roots")
    while not out.where("moved").isEmpty():
        step = out.select(F.col("number").alias("root"), F.col("root").alias("next"))
        out = stored(
            out.join(step, "root", "left").select("number", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
    return out.drop("moved")


def variants(words: DataFrame, times: int = 2, parts: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words with their counts (word, n).

    form: the near word of largest n, if that is at least `times` (2 or more) the word's own n; else NULL. root: where
    the forms lead in the end, the word itself without one. n_near: near words. Ties: the least word by code points.
    parts: ranges of words, as many as shuffle partitions unless given. An empty table gives no rows.
    """
    numbered = stored(words.join(trie_nodes(words, parts), "word"), "nodes")
    near = near_words(pair_rows(numbered, parts))
    own = numbered.select("number", "word", "n").join(near, "number", "left")
    counts = F.col("best.n") >= times * F.col("n")
    own = stored(
        own.select("number", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(counts, -F.col("best.number")).alias("to"), F.when(counts, F.col("best.n")).alias("form_n")),
        "variants",
    )
    linked = own.where("to IS NOT NULL").select("number", "to")
    names = own.select(F.col("number").alias("to"), F.col("word").alias("form"))
    ends = roots(linked).withColumnRenamed("root", "end").join(own.select(F.col("number").alias("end"), F.col("word").alias("root")), "end").drop("end")
    named = linked.join(names, "to").drop("to").join(ends, "number")
    return own.join(named, "number", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_n: int = 3, **kwargs) -> DataFrame:
    """`variants` of the `word_counts` of documents."""
    return variants(word_counts(docs, doc_id, text, least_length, least_n), **kwargs)
