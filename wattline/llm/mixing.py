"""Entropy balancing: document rates that meet token targets by source and stay as near to one as can be.

The rates r minimise the sum of r log r - r over the documents, subject to one constraint a source, the sum of r times the
document's tokens, and to r <= cap. The optimum is an exponential tilt, r = min(cap, exp(l_s z)) with z the document's
tokens over its source's mean; the multipliers l_s maximise the convex dual, which Newton's method does with one
aggregation of the documents an iteration. The rates are then rounded to whole copies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import ROW, columns, numbered, stored

WORD = r"[^\x20\x09-\x0D]+"
#: A tilt beyond this is as good as a rate of 0 or of the cap for a document of mean size.
STEEPEST = 700.0
#: Rates are rounded to whole multiples of 1 / UNIT.
UNIT = 1 << 30
COPIES = "__mix_copies"


def words_of(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets_of(sizes: dict[str | None, int], weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> dict[str | None, float]:
    """Tokens wanted of each source: `share` of all tokens by weight, the weights repeating over the sources in code-point
    order with NULL last; no source beyond `cap` times its size, what is over going to the others by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), list(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > cap * sizes[s]]
        if not over:
            out |= {s: unit * weight[s] for s in free}
            break
        out |= {s: cap * sizes[s] for s in over}
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return {s: out[s] for s in names}


def multipliers(cells: DataFrame, sizes: dict, targets: dict, cap: float, tolerance: float = 1e-6, rounds: int = 60) -> dict:
    """l_s of each source (None: every document at the cap). cells: source, size, n.

    Newton's steps on each source's multiplier, all sources in one aggregation a round. A step that leaves the bracket
    found so far, or has no slope, is replaced by the middle of it.
    """
    spark = cells.sparkSession
    mean = {s: total / n for s, (total, n) in sizes.items() if total}
    todo = {s for s in mean if targets[s] < cap * sizes[s][0] * (1 - 1e-9)}
    tilt: dict = {s: None for s in sizes}
    at, low, high = {s: math.log(max(targets[s] / sizes[s][0], 1e-12)) for s in todo}, dict.fromkeys(todo, -STEEPEST), dict.fromkeys(todo, STEEPEST)
    for _ in range(rounds):
        if not todo:
            break
        now = spark.createDataFrame([(s, at[s], mean[s]) for s in todo], "source string, l double, mean double")
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("l") * z, F.lit(STEEPEST)))
        tokens = F.col("n") * F.col("size")
        sums = cells.join(F.broadcast(now), cells["source"].eqNullSafe(now["source"])).groupBy(now["source"]).agg(
            F.sum(tokens * F.least(rate, F.lit(cap))).alias("taken"),
            F.sum(F.when(rate < cap, tokens * rate * z).otherwise(0.0)).alias("slope"),
        )
        for s, taken, slope in sums.collect():
            gap = targets[s] - taken
            if abs(gap) <= tolerance * max(targets[s], 1.0) or high[s] - low[s] < 1e-12:
                tilt[s] = round(at[s], 9)
                todo.discard(s)
                continue
            (low if gap > 0 else high)[s] = at[s]
            step = at[s] + gap / slope if slope > 0 else math.nan
            at[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
    return tilt | {s: round(at[s], 9) for s in todo}


def mix(docs: DataFrame, targets: dict | None = None, cap: float = 2.0, doc_id: str = "doc_id", text: str = "text", source: str = "source", per_group: int = 65_536, **rule) -> DataFrame:
    """One row per row: doc_id, source, size, source_size, target, rate, copies and taken (copies times size).

    Without `targets` they follow `targets_of`. Sizes are counts of words; a NULL text has none. Documents without words
    have rate 1, and so has a source without words. The copies are a systematic rounding: a source's documents lie in order
    of size, those of one size by a hash, and a document takes a copy whenever the running sum of the rates passes a half.
    That sum is never off by more than a half, so a source's copies are right to within one, and its words, as sizes only
    rise, to within its largest document. Reruns agree, and no document exceeds the cap rounded up. More than `per_group`
    documents of one size are numbered in parts. Equal rows are documents of their own; an empty table gives no rows.
    """
    base = columns(docs, doc_id=doc_id, source=source, text=text).withColumn("row", F.lit(0))
    return _mixed(base, targets, cap, per_group, **rule).drop("draw", "row")


def mixed_copies(docs: DataFrame, cap: float = 2.0, doc_id: str = "doc_id", text: str = "text", source: str = "source", per_group: int = 65_536, **rule) -> DataFrame:
    """The documents with all their columns, each as often as `mix` takes it. NULLs, ties and repeated rows as there."""
    rows = numbered(docs)
    plan = _mixed(columns(rows, doc_id=doc_id, source=source, text=text, row=ROW), None, cap, per_group, **rule)
    taken = plan.where("copies > 0").select(F.col("row").alias(ROW), F.array_repeat(F.lit(0), F.col("copies").cast("int")).alias(COPIES))
    out = rows.join(taken, ROW).withColumn(COPIES, F.explode(COPIES))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _mixed(base: DataFrame, targets: dict | None, cap: float, per_group: int, **rule) -> DataFrame:
    spark = base.sparkSession
    sized = base.select("doc_id", "row", F.col("source").cast("string").alias("source"), words_of(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("draw"))
    sized = stored(sized, "sizes")
    cells = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    by_source = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("size"), F.sum("n").alias("n")).collect()
    sizes = {r.source: (r["size"], r.n) for r in by_source}
    targets = targets_of({s: size for s, (size, _) in sizes.items()}, cap=cap, **rule) if targets is None else targets
    tilt = multipliers(cells.where("size > 0"), sizes, {s: targets.get(s, 0.0) for s in sizes}, cap)
    plan = spark.createDataFrame(
        [(s, size, float(targets.get(s, 0.0)), size / n, tilt[s]) for s, (size, n) in sizes.items()],
        "source string, source_size long, target double, mean double, l double",
    )
    z = F.col("size") / F.col("mean")
    rate = F.when((F.col("size") == 0) | (F.col("source_size") == 0), 1.0).when(F.col("l").isNull(), cap).otherwise(F.least(F.exp(F.least(F.col("l") * z, F.lit(STEEPEST))), F.lit(cap)))
    units = F.round(rate * UNIT).cast("long")  # whole numbers: their sums don't depend on the order
    rated = sized.join(F.broadcast(plan), sized["source"].eqNullSafe(plan["source"])).drop(plan["source"]).withColumn("rate", rate).withColumn("units", units)
    # documents of a source in order of size; those of one size have one rate, so that counts suffice to find their sums
    large = cells.where(F.col("n") > per_group).select(F.col("source").alias("of"), F.col("size").alias("as"), F.ceil(F.col("n") / per_group).alias("parts"))
    rated = rated.join(large, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("as")), "left")
    part = F.coalesce(F.pmod(F.xxhash64("draw", F.lit(1)), F.col("parts")), F.lit(0).cast("long"))
    rated = stored(rated.withColumn("group", part).drop("of", "as", "parts"), "rates")
    sums = rated.groupBy("source", "size", "group").agg(F.sum("units").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("size", "group")) - F.col("sum")
    bases = sums.select(F.col("source").alias("of"), F.col("size").alias("as"), F.col("group").alias("g"), before.alias("before"))
    here = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("as")) & (F.col("group") == F.col("g"))
    placed = rated.join(bases, here).drop("of", "as", "g")
    within = Window.partitionBy("source", "size", "group").orderBy("draw", "doc_id")
    end = F.col("before") + F.row_number().over(within) * F.col("units") + UNIT // 2
    copies = F.expr(f"shiftright(`end`, {UNIT.bit_length() - 1}) - shiftright(`end` - units, {UNIT.bit_length() - 1})")
    out = placed.withColumn("end", end).withColumn("copies", copies)
    return out.select("doc_id", "row", "draw", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
