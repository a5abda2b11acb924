"""Ordered work per series that does not need a whole series in one task.

Most series are short: they are windowed by their key, with one shuffle. A series with more than
`max_rows` rows is cut along its order into chunks of about a quarter of that many rows. Running values
then add up what the earlier chunks hold (one small row per chunk), and row frames read a copied margin
of the neighbouring block.

Which series are long is measured once, by a count per key. They are cut at quantiles of their rows, so
that outliers and bursts don't matter; a value that fills more than a chunk by itself (or rows without
one) is cut on along the ties. Each level of cuts makes at most `FAN` parts of a chunk, so that no sketch of
quantiles and no array of bounds grows with a series, and a row finds its chunk by halving. Operators measure what they are given; where their input is costly,
measure a base table once and pass the result on. An operator on a table with long series stores its
input first, in the checkpoint folder: its plan reads that table, and not all that led to it, again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.session import stored

MAX_ROWS = 4_000_000
#: Parts that one level of cuts makes of a chunk.
FAN = 512
#: Room for the places of one level of cuts in a chunk's number, and the levels that fit into it.
LEVEL, DEEPEST = 1 << 11, 5
#: Steps that halve an array of bounds; a grid's bounds are one level, whatever their number.
HALVES = [1 << i for i in range(24, -1, -1)]


@dataclass(frozen=True)
class Series:
    """Which columns name a series and which order its rows; `ties` makes the order total."""

    keys: tuple[str, ...]
    time: str
    ties: tuple[str, ...] = ()
    max_rows: int | None = MAX_ROWS
    measured: bool = False
    #: the long series with the bounds of their chunks, the bounds by time of chunks that need more cuts, and those by tie
    long: DataFrame | None = field(default=None, compare=False, repr=False)
    levels: tuple[DataFrame, ...] = field(default=(), compare=False, repr=False)
    finer: tuple[tuple[str, DataFrame], ...] = field(default=(), compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "keys", _names(self.keys))
        object.__setattr__(self, "ties", _names(self.ties))

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.time, *self.ties)

    def keyed(self, *more: str) -> "Series":
        return replace(self, keys=(*self.keys, *more))


def _names(value: str | Iterable[str]) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)


def ordinal(df: DataFrame, name: str) -> Column:
    """The order column as a number: microseconds for times, the value itself for numbers."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(name)
    raise TypeError(f"cannot order by {name}: {kind.simpleString()}")


def same(keys: Sequence[str], prefix: str) -> Column:
    """NULL-safe equality of key columns with their prefixed copies."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join `small` on `keys`, NULL equal to NULL, keeping one copy of the keys. A plain join on keys
    that are never NULL keeps an existing partitioning; this one cannot."""
    joined = df.join(prefixed(small, keys, "_r_"), same(keys, "_r_"), how)
    return joined.drop(*["_r_" + k for k in keys])


def measure(df: DataFrame, series: Series, step: int | None = None) -> Series:
    """Count the rows of each series and remember the long ones: one pass over the key and time columns.

    With `step` (in units of the order value) the rows are those of a regular grid from the first to the
    last order value, which need not exist yet.
    """
    if series.max_rows is None:
        return replace(series, measured=True, long=None)
    at = ordinal(df, series.time)
    counted = df.groupBy(*series.keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi")
    )
    if step:
        counted = counted.withColumn("_n", F.ceil((F.col("_hi") - F.col("_lo")) / step) + 1)
    target = max(1, series.max_rows // 4)
    most = counted.agg(F.max("_n")).first()[0] or 0
    if most <= series.max_rows:
        return replace(series, measured=True, long=None)
    pieces = math.ceil(most / target)
    own = counted.where(F.col("_n") > series.max_rows).withColumn("_pieces", F.ceil(F.col("_n") / target))
    if step:
        width = (F.col("_hi") - F.col("_lo")) / F.col("_pieces")
        bounds = F.transform(F.sequence(F.lit(1), F.col("_pieces").cast("int")), lambda i: (F.col("_lo") + width * i).cast("long"))
        return replace(series, measured=True, long=stored(own.select(*series.keys, bounds.alias("_bounds")), "long-series"))
    rows = attach(df.select(*series.keys, at.alias("_at"), *series.ties), own.select(*series.keys, "_pieces"), series.keys, "inner")
    long = stored(_bounds(rows, series.keys, "_at", min(pieces, FAN)), "long-series")
    found = replace(series, measured=True, long=long)
    for _ in range(_depth(pieces) - 1):
        bounds, _ = _cut(df, found, series.time, _several_values(), target)
        if bounds is None:
            break
        found = replace(found, levels=(*found.levels, bounds))
    for tie in series.ties:
        if not _numeric(df, tie):
            break
        # rows of one value are cut on along the next tie
        bounds, pieces = _cut(df, found, tie, _one_value(), target)
        if bounds is None:
            break
        found = replace(found, finer=(*found.finer, (tie, bounds)))
        for _ in range(_depth(pieces) - 1):
            bounds, _ = _cut(df, found, tie, _several_values(), target)
            if bounds is None:
                break
            found = replace(found, finer=(*found.finer, (tie, bounds)))
    return found


def _depth(pieces: int) -> int:
    """Levels of cuts that make this many pieces."""
    depth = 1
    while FAN**depth < pieces:
        depth += 1
    return depth


def _cut(df: DataFrame, found: Series, by: str, which: Column, target: int) -> tuple[DataFrame | None, int]:
    """Bounds by a column of those chunks that are too large, and the pieces that the largest of them needs."""
    if 1 + len(found.levels) + len(found.finer) == DEEPEST:
        return None, 0
    keys = (*found.keys, "_chunk")
    own = _chunked(df, found).where((F.col("_chunk") > 0) & which)
    heavy = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target)
    heavy = stored(heavy.withColumn("_pieces", F.ceil(F.col("_n") / target)), "heavy-chunks")
    pieces = heavy.agg(F.max("_pieces")).first()[0]
    if pieces is None:
        return None, 0
    rows = attach(own.select(*keys, ordinal(df, by).alias("_at")), heavy.select(*keys, "_pieces"), keys, "inner")
    return stored(_bounds(rows, keys, "_at", min(pieces, FAN)), "finer-bounds"), pieces


def _numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType))


def _bounds(rows: DataFrame, keys: Sequence[str], at: str, pieces: int) -> DataFrame:
    """For each key the values at which its rows fall into `_pieces` parts of equal counts."""
    cuts = F.array(*[F.lit(i / pieces) for i in range(1, pieces)]) if pieces > 1 else F.array(F.lit(0.5))
    found = rows.groupBy(*keys).agg(
        F.percentile_approx(at, cuts, F.lit(max(10_000, 50 * pieces))).alias("_quantiles"), F.max("_pieces").alias("_pieces")
    )
    every = F.greatest(F.floor(F.lit(pieces) / F.least(F.col("_pieces"), F.lit(pieces))), F.lit(1))
    thinned = F.filter("_quantiles", lambda x, i: (i + 1) % every == 0)
    return found.select(*keys, F.array_distinct(thinned).alias("_bounds"))


def _place(at: Column, bounds: Column) -> Column:
    """Where a value lies among sorted bounds: 1 for NULL, even between two bounds, odd on one."""

    def place(v: Column) -> Column:
        below = F.aggregate(
            F.array(*[F.lit(i) for i in HALVES]), F.lit(0), lambda n, i: F.when(F.get(bounds, n + i - 1) < v, n + i).otherwise(n)
        )
        return F.transform(F.array(below), lambda n: 2 * n + 2 + F.coalesce((F.get(bounds, n) == v).cast("int"), F.lit(0)))[0]

    return F.when(at.isNull(), 1).otherwise(F.transform(F.array(at), place)[0]).cast("long")


def _one_value() -> Column:
    """Whether a chunk's rows have the same order value and, further down, the same ties."""
    return F.col("_chunk") % 2 == 1


def _several_values() -> Column:
    """Whether a chunk was made by the last level's cuts and lies between two bounds."""
    return (F.col("_chunk") % LEVEL > 0) & (F.col("_chunk") % 2 == 0)


def _chunked(df: DataFrame, series: Series) -> DataFrame:
    """df with `_chunk`: 0 for short series, else a number that grows along the order."""
    out = attach(df, series.long, series.keys)
    here = _place(ordinal(df, series.time), F.col("_bounds"))
    out = out.withColumn("_chunk", F.when(F.col("_bounds").isNull(), 0).otherwise(here).cast("long")).drop("_bounds")
    before = series.time
    for by, bounds in (*((series.time, b) for b in series.levels), *series.finer):
        out = attach(out, bounds, (*series.keys, "_chunk"))
        # a chunk of one value stays one while the same column is cut; others that are not cut here have several, or few rows
        kept = F.col("_chunk") % 2 if by == before else F.lit(0)
        within = F.when(F.col("_bounds").isNull(), kept).otherwise(_place(ordinal(df, by), F.col("_bounds")))
        out = out.withColumn("_chunk", F.when(F.col("_chunk") == 0, 0).otherwise(F.col("_chunk") * LEVEL + within)).drop("_bounds")
        before = by
    return out


class Part:
    """A table to work on: of short series only, or with a `_chunk` column."""

    def __init__(self, series: Series, chunked: bool):
        self.series = series
        self.chunked = chunked

    def running(self, df: DataFrame, specs: Mapping[str, tuple[str, Column, bool]]) -> DataFrame:
        """Add running values: name -> ("sum" or "max", expression, whether the row itself counts)."""
        local = self.series.keyed("_chunk") if self.chunked else self.series
        upto = {
            inclusive: local.window().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
            for inclusive in (True, False)
        }
        calls = {"sum": F.sum, "max": F.max}
        if not self.chunked:
            columns = [calls[f](e).over(upto[inc]).alias(name) for name, (f, e, inc) in specs.items()]
            return self._zeros(df.select("*", *columns), specs)

        inputs = {f"_in_{name}": e for name, (_, e, _) in specs.items()}
        df = df.withColumns(inputs)
        per_chunk = df.where("_chunk > 0").groupBy(*local.keys).agg(
            *[calls[f](f"_in_{name}").alias(f"_at_{name}") for name, (f, _, _) in specs.items()]
        )
        before = (
            Window.partitionBy(*self.series.keys)
            .orderBy("_chunk")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = per_chunk.select(
            *local.keys,
            *[
                calls[f](f"_at_{name}").over(before).alias(f"_before_{name}")
                for name, (f, _, _) in specs.items()
            ],
        )
        df = df.select(
            "*",
            *[
                calls[f](f"_in_{name}").over(upto[inc]).alias(f"_here_{name}")
                for name, (f, _, inc) in specs.items()
            ],
        )
        df = attach(df, carry, local.keys)
        out = {}
        for name, (f, _, _) in specs.items():
            here, prior = F.col(f"_here_{name}"), F.col(f"_before_{name}")
            # greatest() skips NULLs; a sum over nothing is NULL on both sides only at the very start
            out[name] = (
                F.greatest(here, prior)
                if f == "max"
                else F.when(here.isNull(), prior).otherwise(here + F.coalesce(prior, F.lit(0)))
            )
        helpers = [p + name for name in specs for p in ("_in_", "_here_", "_before_")]
        return self._zeros(df.withColumns(out).drop(*helpers), specs)

    @staticmethod
    def _zeros(df: DataFrame, specs) -> DataFrame:
        sums = {n: F.coalesce(F.col(n), F.lit(0)) for n, (f, _, _) in specs.items() if f == "sum"}
        return df.withColumns(sums) if sums else df

    def frames(
        self, df: DataFrame, build: Callable[[DataFrame, Series], DataFrame], back: int, ahead: int = 0
    ) -> DataFrame:
        """Run `build`, whose windows look at most `back` rows behind and `ahead` rows ahead."""
        if not self.chunked:
            return build(df, self.series)
        size = max(self.series.max_rows // 4, back, ahead, 1)
        df = self.running(df, {"_pos": ("sum", F.lit(1), False)})
        block, within = F.floor(F.col("_pos") / size), F.col("_pos") % size
        targets = F.array_compact(
            F.array(
                block,
                F.when(within >= size - back, block + 1),
                F.when((within < ahead) & (block > 0), block - 1),
            )
        )
        df = df.withColumn("_own", block).withColumn("_block", F.explode(targets))
        done = build(df, self.series.keyed("_block"))
        return done.where(F.col("_own") == F.col("_block")).drop("_own", "_block", "_pos")

    def whole(self, df: DataFrame, specs: Mapping[str, Column]) -> DataFrame:
        """Add aggregates of the whole series to each of its rows."""
        if not self.chunked:
            over = Window.partitionBy(*self.series.keys)
            return df.select("*", *[e.over(over).alias(n) for n, e in specs.items()])
        totals = df.groupBy(*self.series.keys).agg(*[e.alias(n) for n, e in specs.items()])
        return attach(df, totals, self.series.keys)

    def group_count(self, df: DataFrame, group: str, name: str) -> DataFrame:
        """Add the number of rows that share `group` within the series."""
        keys = (*self.series.keys, group)
        if not self.chunked:
            return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        return attach(df, counts, keys)


def per_series(df: DataFrame, series: Series, build: Callable[[Part, DataFrame], DataFrame]) -> DataFrame:
    """Apply `build` to all series, cut into chunks if some are long."""
    if not series.measured:
        series = measure(df, series)
    if series.long is None:
        return build(Part(series, False), df)
    return build(Part(series, True), stored(_chunked(df, series), "chunked")).drop("_chunk")


def positions(df: DataFrame, series: Series, name: str = "position") -> DataFrame:
    """0-based place of each row in its series."""
    return per_series(
        df, series, lambda part, d: part.running(d, {name: ("sum", F.lit(1).cast("long"), False)})
    )
