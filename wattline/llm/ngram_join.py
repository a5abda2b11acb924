"""N-gram Jaccard join: a grouped prefix join of the documents' sets of word shingles.

Shingles are 64-bit hashes in one order for all documents, rare ones first. Two sets that are similar enough share a
shingle, and long sets several, in their prefixes, the first few of each. Documents with the same prefix and size are one group, and groups stand
for their documents in the index by prefix shingle. Each group has a home, one of its shingles that others share. In a
home, members are verified against its leader, then those that differ from it against all others, in blocks: all of a
large home, and of a small one those of their group. Pairs that share a shingle but no such block are verified last. Links are kept as far as components need them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import ROW, Hashes, Tally, arrow_table, columns, each, kind_of, lists_of, lookup, numbered, rows_of, shingles, signed, slices, stored, utf8
from wattline.llm.components import components
from wattline.llm.hash_index import bit_set

#: Rows and bytes of sets in a block of members that are verified together.
BLOCK_ROWS, BLOCK_BYTES = 128, 1 << 21
#: Members of a shingle up to which they are paired rather than dealt into blocks.
PAIRED = 64


def sets_of(texts: list[bytes], k: int, hashes: Hashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z in lower case."""
    words = [t.lower().split() for t in texts]
    flat = hashes.of([w for x in words for w in x])
    every = shingles(flat, k) if len(flat) >= k else flat[:0]
    out, begin = [], 0
    for x in words:
        end = begin + len(x)
        out.append(np.unique(every[begin : end - k + 1]) if len(x) >= k else shingles(flat[begin:end], k))
        begin = end
    return out


def node_of(s: np.ndarray) -> int:
    """64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(s.tobytes())


def common_shingles(texts: DataFrame, k: int, share: float, window: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles with at least about `share` of all, and their counts: at most 1 / share of them.

    A shingle as common as that is so within some stretch of the input too; only those are summed. What a stretch leaves
    out makes a count a little low, which changes the order of the shingles and not the result.
    """
    schema = "code long, n long, total long"
    fields = arrow_table(schema)

    def work(batches):
        tally, hashes, seen = Tally(window), Hashes(), 0

        def rows(found, seen):
            for _, codes, n in found:
                often = n >= max(3, share * seen)
                yield rows_of(fields, signed(codes[often]), n[often], np.zeros(often.sum(), np.int64))

        total = 0
        for b in slices(batches):
            codes = each(sets_of(utf8(b.column(0)), k, hashes), np.uint64)
            total, seen = total + len(codes), seen + len(codes)
            for part in tally.add(0, codes):
                yield from rows([part], seen)
                seen = 0
        yield from rows(tally.rest(), seen)
        yield rows_of(fields, [0], [0], [total])

    found = stored(texts.mapInArrow(work, schema), "common")
    total = found.agg(F.sum("total")).first()[0] or 0
    often = found.where("n > 0").groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= max(3.0, share * total)).toArrow()
    code, n = often.column(0).to_numpy().view(np.uint64), often.column(1).to_numpy()
    order = np.argsort(code)
    return code[order], n[order]


def least_common(n: int, percent: int) -> int:
    """The least size of an intersection with a set of size n that is similar enough."""
    return -(-percent * n // 100)


def step(percent: int) -> int:
    """A prefix is longer than one shared shingle asks for by one part in `step`: from 90 % on, where prefixes are short,
    twice as long, else by a third. The longer it is, the more shingles have to be shared, and the fewer sets that share
    some by chance are looked at."""
    return 1 if percent >= 90 else 3


def shared_size(n: int, percent: int) -> int:
    """How many shingles the prefix of a set of size n is to share: one, and one more for each that it is longer."""
    least = least_common(n, percent)
    return min(1 + (n - least) // step(percent), least)


def prefix_size(n: int, percent: int) -> int:
    """Similar sets of sizes n and m share as many shingles of their prefixes as the smaller one's `shared_size`."""
    return n - least_common(n, percent) + shared_size(n, percent)


def needed(n: int, percent: int) -> int:
    """Shingles of its prefix that a set of size n shares with any similar one, however small that may be."""
    return shared_size(least_common(n, percent), percent)


def needed_sql(n: str, percent: int) -> str:
    """`needed` of a column."""
    least = f"(({percent} * {n} + 99) div 100)"
    second = f"(({percent} * {least} + 99) div 100)"
    return f"least(1 + ({least} - {second}) div {step(percent)}, {second})"


def pair_needed(n: int, m: int, percent: int) -> int:
    """Shingles of their prefixes that similar sets of these sizes share: all but those of the intersection that may lie
    behind the prefix of one of them, the one whose prefix ends first in the order."""
    common = -(-percent * (n + m) // (100 + percent))
    return min(shared_size(x, percent) + common - least_common(x, percent) for x in (n, m))


def pair_needed_sql(n: str, m: str, percent: int) -> str:
    """`pair_needed` of two columns."""
    common = f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"
    least = "(({p} * {x} + 99) div 100)"
    own = [f"least(1 + ({x} - {least.format(p=percent, x=x)}) div {step(percent)}, {least.format(p=percent, x=x)}) + {common} - {least.format(p=percent, x=x)}" for x in (n, m)]
    return f"least({own[0]}, {own[1]})"


def text_hashes(texts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts))


def signatures(base: DataFrame, k: int, percent: int, share: float) -> DataFrame:
    """Of each row of (doc_id, text): doc_id, n (size of the set), node, gid (name of size and prefix), text_hash, prefix.
    The prefix stands with a group's first row in a task only."""
    shared = base.sparkSession.sparkContext.broadcast(common_shingles(base.select("text"), k, share))
    schema = f"doc_id {kind_of(base, 'doc_id')}, n long, node long, gid long, text_hash long, prefix array<long>"
    fields = arrow_table(schema)

    def work(batches):
        common, count = shared.value
        hashes, done = Hashes(), set()
        for b in slices(batches, 1):
            texts = utf8(b.column(1))
            sets = sets_of(texts, k, hashes)
            prefixes = []
            for s in sets:
                hit, at = lookup(common, s)
                rank = np.where(hit, count[at], 0) if len(common) else np.zeros(len(s), np.int64)
                prefixes.append(s[np.lexsort((s, rank))[: prefix_size(len(s), percent)]] if len(s) else s)
            node = np.fromiter(map(node_of, sets), np.uint64, len(sets))
            sizes = np.array([len(s) for s in sets])
            gid = np.fromiter((xxhash.xxh3_64_intdigest(p.tobytes(), seed=len(s)) for p, s in zip(prefixes, sets)), np.uint64, len(sets))
            for i, g in enumerate(gid.tolist()):
                if g in done:
                    prefixes[i] = prefixes[i][:0]
                done.add(g)
            if len(done) > 1_000_000:
                done.clear()
            lengths = np.array([len(p) for p in prefixes])
            yield rows_of(fields, b.column(0), sizes, signed(node), signed(gid), signed(text_hashes(texts)), lists_of(signed(each(prefixes, np.uint64)), lengths, pa.int64()))

    return base.mapInArrow(work, schema)


def in_bits(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the keys (signed) are in a `bit_set`."""
    place = keys % (len(words) << 6)
    return (words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def shared_postings(real: DataFrame, percent: int, bits: int) -> DataFrame:
    """gid, n, place, token: the prefix shingles that a group shares with others, of groups that share enough of them."""
    spark = real.sparkSession
    tokens = real.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    shared = spark.sparkContext.broadcast(bit_set(tokens.select("key"), bits))
    schema = "gid long, n long, place long, token long"
    fields = arrow_table(schema)

    def work(batches):
        for b in batches:
            size = b.column(1).to_numpy(zero_copy_only=False)
            prefix = b.column(2)
            flat, length = prefix.flatten().to_numpy(), np.diff(prefix.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), length)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            hit = in_bits(shared.value, flat)
            enough = np.bincount(row[hit], minlength=len(size)) >= np.array([needed(n, percent) for n in size.tolist()])
            hit &= enough[row]
            yield rows_of(fields, b.column(0).to_numpy(zero_copy_only=False)[row[hit]], size[row[hit]], place[hit], flat[hit])

    likely = real.where(F.size("prefix") > 0).select("gid", "n", "prefix").mapInArrow(work, schema)
    kept = likely.repartition("gid").dropDuplicates(["gid", "token"])  # a group's rows meet once for this and for their count
    own = F.count("*").over(Window.partitionBy("gid"))
    for _ in range(2):  # what a group shares with itself, or with groups that don't share enough, is no use
        enough = kept.withColumn("own", own).where(F.col("own") >= F.expr(needed_sql("n", percent)))
        kept = stored(enough.drop("own"), "shared-postings")
        kept = kept.join(kept.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token"), "token", "left_semi")
        kept = stored(kept, "shared-postings")
    return kept


def whole_sets(base: DataFrame, k: int, texts: DataFrame, bits: int) -> DataFrame:
    """node, items (the hashes of its set as bytes), once each, for about the texts with the wanted hashes (key)."""
    shared = base.sparkSession.sparkContext.broadcast(bit_set(texts, bits))
    schema = "node long, items binary"
    fields = arrow_table(schema)

    def work(batches):
        hashes, done = Hashes(), set()
        for b in slices(batches, 0):
            texts = utf8(b.column(0))
            own = signed(text_hashes(texts))
            new = {h: i for i, h in enumerate(own.tolist()) if h not in done}
            at = [i for i, hit in zip(new.values(), in_bits(shared.value, own[list(new.values())])) if hit]
            done.update(own[at].tolist())
            if len(done) > 1_000_000:
                done.clear()
            sets = [s for s in sets_of([texts[i] for i in at], k, hashes) if len(s)]
            if sets:
                yield rows_of(fields, signed(np.fromiter(map(node_of, sets), np.uint64, len(sets))), [s.tobytes() for s in sets])

    return base.select("text").mapInArrow(work, schema).groupBy("node").agg(F.any_value("items").alias("items"))


def similar(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def against_leader(rows: DataFrame, percent: int) -> DataFrame:
    """Whether each member (home, node, items) is similar to its home's leader (leader, leader_items)."""
    schema = "home long, node long, size long, leader long, linked boolean"
    fields = arrow_table(schema)

    def work(batches):
        for b in slices(batches, 4):
            a, lead = ([np.frombuffer(x, np.uint64) for x in b.column(i).to_pylist()] for i in (2, 4))
            common = np.array([lookup(y, x)[0].sum() for x, y in zip(a, lead)])
            sizes, other = (np.array([len(x) for x in y]) for y in (a, lead))
            yield rows_of(fields, b.column(0), b.column(1), sizes, b.column(3), similar(common, sizes, other, percent))

    return rows.select("home", "node", "items", "leader", "leader_items").mapInArrow(work, schema)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar."""
    own = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    schema = "a long, b long"
    fields = arrow_table(schema)

    def work(batches):
        for b in slices(batches, 2):
            x, y = ([np.frombuffer(v, np.uint64) for v in b.column(i).to_pylist()] for i in (2, 3))
            common = np.array([lookup(v, u)[0].sum() for u, v in zip(x, y)])
            ok = pa.array(similar(common, np.array([len(v) for v in x]), np.array([len(v) for v in y]), percent))
            yield rows_of(fields, b.column(0).filter(ok), b.column(1).filter(ok))

    return own.select("a", "b", "x", "y").mapInArrow(work, schema)


def overlaps(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Size of the intersection of each set of a with each of b, from products of membership matrices."""
    x, y = each(a, np.uint64), each(b, np.uint64)
    both = np.intersect1d(x, y)
    out = np.zeros((len(a), len(b)), np.float32)
    sides = []
    for flat, sets in ((x, a), (y, b)):
        hit, at = lookup(both, flat)
        sides.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]))
    for begin in range(0, len(both), width):
        member = []
        for (row, col), sets in zip(sides, (a, b)):
            own = (col >= begin) & (col < begin + width)
            m = np.zeros((len(sets), min(width, len(both) - begin)), np.float32)
            m[row[own], col[own] - begin] = 1
            member.append(m)
        out += member[0] @ member[1].T
    return out.astype(np.int64)


def spanning(pairs) -> list[tuple[int, int]]:
    """The pairs that join two parts not joined before."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


def block_links(percent: int):
    """Links within a pair of blocks: rows (left, node, part, items); rows with `left` against all others whose part differs
    or is NULL."""

    def work(block: pa.Table) -> pa.Table:
        left = block.column("left").to_numpy(zero_copy_only=False).astype(bool)
        node, part = block.column("node").to_numpy(), np.array([0 if x is None else x for x in block.column("part").to_pylist()], np.int64)
        free = np.array([x is None for x in block.column("part").to_pylist()])
        sets = [np.frombuffer(x, np.uint64) for x in block.column("items").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        rows, cols = np.flatnonzero(left), np.arange(len(sets)) if left.all() else np.flatnonzero(~left)
        common = overlaps([sets[i] for i in rows], [sets[i] for i in cols])
        ok = similar(common, sizes[rows][:, None], sizes[cols][None, :], percent)
        ok &= (node[rows][:, None] != node[cols][None, :]) & (free[rows][:, None] | free[cols][None, :] | (part[rows][:, None] != part[cols][None, :]))
        i, j = np.nonzero(ok)
        found = spanning(zip(node[rows[i]].tolist(), node[cols[j]].tolist()))
        return pa.table([pa.array([p[x] for p in found], pa.int64()) for x in (0, 1)], names=["a", "b"])

    return work


def in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links among the rows (key, node, open, part, size, items) of each key: each open row against every row of its key,
    but those of the same part. Rows of a key are dealt into blocks, and the pairs of blocks are tasks of their own."""
    rows = rows.withColumn("bytes", 8 * F.col("size"))
    per_key = rows.groupBy("key", "open").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    counts = per_key.groupBy("key").agg(
        F.max(F.when(F.col("open"), F.col("blocks"))).alias("opened"), F.coalesce(F.max(F.when(~F.col("open"), F.col("blocks"))), F.lit(0)).alias("closed")
    ).where("opened is not null")
    at = F.pmod(F.xxhash64("node"), F.when(F.col("open"), F.col("opened")).otherwise(F.col("closed"))).cast("int")
    dealt = rows.join(counts, "key").withColumn("block", at)
    # an open row meets each open block, and as the left side each closed one; a closed row meets each open block
    open_pairs = F.transform(F.sequence(F.lit(0), F.col("opened") - 1), lambda o: F.struct(F.least(o, "block").alias("i"), F.greatest(o, "block").alias("j"), F.lit(False).alias("closed"), (F.col("block") <= o).alias("left")))
    to_closed = F.when(F.col("closed") > 0, F.transform(F.sequence(F.lit(0), F.col("closed") - 1), lambda c: F.struct(F.col("block").alias("i"), c.alias("j"), F.lit(True).alias("closed"), F.lit(True).alias("left")))).otherwise(F.array())
    from_closed = F.transform(F.sequence(F.lit(0), F.col("opened") - 1), lambda o: F.struct(o.alias("i"), F.col("block").alias("j"), F.lit(True).alias("closed"), F.lit(False).alias("left")))
    tasks = F.when(F.col("open"), F.concat(open_pairs, to_closed)).otherwise(from_closed)
    spread = dealt.select("key", "node", "part", "items", F.explode(tasks).alias("t"))
    spread = spread.select("key", "t.i", "t.j", F.col("t.closed").alias("against_closed"), "t.left", "node", "part", "items")
    return spread.groupBy("key", "i", "j", "against_closed").applyInArrow(block_links(percent), "a long, b long")


def link_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, share: float = 2e-7, bits: int = 1 << 23, token_bits: int = 1 << 25) -> DataFrame:
    """One row per row: doc_id, n_shingles and component_id, the least id that can be reached by links.

    The set of a text: its distinct shingles of k words (runs of characters other than ASCII white space, A-Z in lower
    case); the whole sequence if it has fewer; none without words or text, and then no links. Two texts link if 100 times
    the size of the intersection is at least `percent` times that of the union. All links between components are found;
    equal sets are one node. NULL ids are passed over in a component's least id; without any other it is NULL.
    """
    base = columns(docs, doc_id=doc_id, text=text)
    found = stored(signatures(base, k, percent, share), "signatures")
    real = found.where("n > 0")
    members = real.groupBy("gid", "node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.any_value("text_hash").alias("text_hash"))
    members = stored(members, "members")
    links = stored(_links(base, real, members, k, percent, bits, token_bits), "links")
    joined = components(links)
    nodes = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows")).where("rows > 1")
    named = nodes.join(least.drop("rows"), "component").select("node", "component_id")
    out = found.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    alone = F.col("component_id").isNull()
    return out.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _links(base: DataFrame, real: DataFrame, members: DataFrame, k: int, percent: int, bits: int, token_bits: int) -> DataFrame:
    """Links (a, b) between nodes that make up the components."""
    kept = shared_postings(real, percent, token_bits)
    df = kept.groupBy("token").agg(F.count("*").alias("df"))
    ranked = kept.join(df, "token")
    # the home: the first shingle in the order that about as many groups share as share any of the group's; a group with
    # several members that shares none is at home by itself
    top = ranked.groupBy("gid").agg(F.max("df").alias("top"))
    home = ranked.join(top, "gid").where("2 * df >= top").groupBy("gid").agg(F.min_by("token", "place").alias("home"))
    several = members.groupBy("gid").agg(F.count("*").alias("m")).where("m > 1")
    home = home.join(several, "gid", "full").select("gid", F.coalesce("home", "gid").alias("home"))
    at_home = stored(members.select("gid", "node", "least", "text_hash").join(home, "gid"), "homes")
    sets = stored(whole_sets(base, k, at_home.select(F.col("text_hash").alias("key")), bits), "sets")
    order = F.struct(F.col("least").isNull(), "least", "node")
    leaders = at_home.groupBy("home").agg(F.min_by("node", order).alias("leader"), F.count("*").alias("there")).where("there > 1")
    lead = stored(leaders.join(sets, leaders["leader"] == sets["node"]).select("home", "leader", F.col("items").alias("leader_items")), "leaders")
    present = at_home.join(sets, "node").select("home", "node", "items").join(lead, "home")
    checked = stored(against_leader(present, percent), "against-leaders")
    first = checked.where("linked and node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    # homes where some differ from the leader: those against all of a large home; in a small one against all of their
    # group, whose members share more than the shingles that other groups share, too
    is_large = F.col("there") > PAIRED
    large = leaders.where(is_large).select("home")
    apart = checked.where("not linked").select("home").distinct().join(leaders.select("home", "there"), "home")
    within = checked.join(apart, "home").join(at_home.select("node", "gid"), "node").join(several, "gid", "left")
    within = within.where(is_large | ((F.col("m") > 1) & (F.col("there") > 2)))
    rows = within.withColumn("key", F.when(is_large, F.col("home")).otherwise(F.col("gid"))).join(sets, "node").select(
        "key", "node", (~F.col("linked")).alias("open"), F.lit(None).cast("long").alias("part"), "size", "items"
    )
    links = stored(first.union(in_blocks(rows, percent)), "home-links")
    # what shares a shingle, but neither a large home nor a group nor a component
    joined = components(links)
    placed = at_home.join(joined, "node", "left").select("gid", "node", "home", F.coalesce("component", "node").alias("part"))
    placed = placed.join(large.withColumn("large", F.lit(True)), "home", "left").select("gid", "node", "home", "part", F.coalesce("large", F.lit(False)).alias("large"))
    placed = stored(kept.select("gid", "n", "token").join(placed, "gid"), "placed")
    open_tokens = placed.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("df")).where("p <> q")
    left = stored(placed.join(open_tokens.select("token", "df"), "token"), "open-postings")
    few, many = left.where(F.col("df") <= PAIRED), left.where(F.col("df") > PAIRED)
    # a shingle of few members: pairs, if they share enough of them, or could with the others
    others = many.groupBy("node").agg(F.count("*").alias("others"))
    few = few.join(others, "node", "left").select("token", "node", "n", "gid", "home", "large", "part", F.coalesce("others", F.lit(0)).alias("others"))
    few = few.repartition("token")  # both sides read this one shuffle, for they use the same columns
    x, y = (few.select("token", *[F.col(c).alias(side + c) for c in few.columns if c != "token"]) for side in "xy")
    met = x.join(y, "token").where(
        (F.col("xnode") < F.col("ynode")) & (F.col("xpart") != F.col("ypart")) & (F.col("xgid") != F.col("ygid")) & ~(F.col("xlarge") & F.col("ylarge") & (F.col("xhome") == F.col("yhome")))
        & (100 * F.least("xn", "yn") >= percent * F.greatest("xn", "yn"))
    )
    met = met.groupBy("xnode", "ynode").agg(F.count("*").alias("shared"), *[F.max(c).alias(c) for c in ("xn", "yn", "xothers", "yothers")])
    met = met.where(F.col("shared") + F.least("xothers", "yothers") >= F.expr(pair_needed_sql("xn", "yn", percent)))
    paired = verified(met.select(F.col("xnode").alias("a"), F.col("ynode").alias("b")), sets, percent)
    # a shingle of many: those at home elsewhere than most, and those of small homes, in blocks
    crossing = many.groupBy("token").agg(F.min("home").alias("h"), F.max("home").alias("i")).where("h <> i").select("token")
    many = many.join(crossing, "token")
    of_home = many.groupBy("token", "home").agg(F.count("*").alias("n"))
    main = of_home.groupBy("token").agg(F.max_by("home", F.struct("n", "home")).alias("main"))
    size = (F.length("items") / 8).cast("long")
    rest = many.join(main, "token").join(sets, "node").select(F.col("token").alias("key"), "node", ((F.col("home") != F.col("main")) | ~F.col("large")).alias("open"), "part", size.alias("size"), "items")
    return links.union(paired).union(in_blocks(rest, percent))


def one_of_each(docs: DataFrame, text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, one of each component: the first as they are stored."""
    rows = numbered(docs)
    found = link_components(rows, ROW, text, k, percent)
    return rows.join(found.where("doc_id = component_id").select(F.col("doc_id").alias(ROW)), ROW, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
