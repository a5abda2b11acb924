"""Joining event intervals to a time series without emitting a row per (event, reading) pair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.config import KNOWN_FAULT_CODES
from wattline.functions.scalar import fault_code
from wattline.operators.series import Part, Series, attach, ordinal, per_series, positions

SECOND = 1_000_000
#: Codes up to which flags are counted code by code.
COUNTED_CODES = 64
#: Tiles of the longest event up to which all events are cut into tiles of one size.
SHORT = 16


def clean_faults(
    faults: DataFrame, start: str = "activated_at", end: str = "fixed_at", code: str = "code"
) -> DataFrame:
    """Clean codes; drop events without start or code and events that end before they start."""
    out = faults.withColumn(code, fault_code(code))
    keep = F.col(start).isNotNull() & (F.col(code) != "")
    return out.where(keep & (F.col(end).isNull() | (F.col(end) >= F.col(start))))


def code_universe(faults: DataFrame, code: str = "code", known: Sequence[str] = KNOWN_FAULT_CODES) -> DataFrame:
    """Known codes and the clean codes seen, one row each."""
    listed = faults.sparkSession.createDataFrame([(c,) for c in known], f"{code} string")
    return faults.select(code).where(F.col(code) != "").union(listed).distinct()


def fault_codes(faults: DataFrame, code: str = "code", known: Sequence[str] = KNOWN_FAULT_CODES) -> list[str]:
    """The code universe as names. Each becomes a column of the flagged rows."""
    return sorted(r[0] for r in code_universe(faults, code, known).collect())


def merged_intervals(
    faults: DataFrame, keys: Sequence[str], start: str = "activated_at", end: str = "fixed_at", code: str = "code"
) -> DataFrame:
    """keys, code, _from, _till (exclusive, in microseconds; NULL is open): the times at which a code is active, as
    intervals that neither overlap nor touch. Both ends of an interval belong to it."""
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in (start, end))
    forever = F.lit((1 << 63) - 1)
    known = faults.select(*keys, F.col(code).alias("code"), first.alias("_from"), F.coalesce(last + 1, forever).alias("_till"))
    known = known.where(F.col("_from").isNotNull() & (F.col("_till") > F.col("_from")) & F.col("code").isNotNull()).distinct()
    order = Window.partitionBy(*keys, "code").orderBy("_from", "_till")
    reach = F.max("_till").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = known.withColumn("_new", F.when(reach.isNull() | (F.col("_from") > reach), 1).otherwise(0))
    island = fresh.withColumn("_island", F.sum("_new").over(order))
    out = island.groupBy(*keys, "code", "_island").agg(F.min("_from").alias("_from"), F.max("_till").alias("_till"))
    return out.withColumn("_till", F.nullif("_till", forever)).drop("_island")


def open_runs(
    faults: DataFrame, keys: Sequence[str], start: str = "activated_at", end: str = "fixed_at", code: str = "code"
) -> DataFrame:
    """keys, _run, _at, codes: from the time `_at` on, up to the key's next run, just these codes are active (sorted).

    Runs are numbered in time order. An interval is copied into the runs it spans, which is what the sets hold.
    """
    spans = merged_intervals(faults, keys, start, end, code)
    moments = F.explode(F.array("_from", "_till")).alias("_at")
    points = spans.select(*keys, moments).where(F.col("_at").isNotNull()).distinct()
    points = positions(points, Series(tuple(keys), "_at"), "_run")
    begins = attach(spans, points.select(*keys, F.col("_at").alias("_from"), F.col("_run").alias("_first")), [*keys, "_from"], "inner")
    ends = attach(begins, points.select(*keys, F.col("_at").alias("_till"), F.col("_run").alias("_next")), [*keys, "_till"])
    counts = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_runs"))
    ends = attach(ends, counts, keys)
    upto = F.when(F.col("_till").isNull(), F.col("_runs")).otherwise(F.col("_next")) - 1
    each = ends.select(*keys, "code", F.explode(F.sequence(F.col("_first"), upto)).alias("_run"))
    sets = each.groupBy(*keys, "_run").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return attach(points, sets, [*keys, "_run"]).withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))


def open_codes(
    df: DataFrame,
    faults: DataFrame,
    series: Series,
    start: str = "activated_at",
    end: str = "fixed_at",
    code: str = "code",
    name: str = "open_codes",
) -> DataFrame:
    """Add the sorted codes of the intervals of the same key that cover the row's time, both ends included.

    Runs and rows are walked in time order with one running value, the newest run. An interval without an end stays
    open; one that ends before it starts, or has no start or code, is ignored. A row without a time has no codes.
    """
    runs = open_runs(faults, series.keys, start, end, code)
    walk = df.withColumns({"_at": ordinal(df, series.time), "_kind": F.lit(1)}).unionByName(
        runs.withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    # the rows' own measure serves: runs only add to them
    order = replace(series, time="_at", ties=("_kind",), finer=())
    run = F.when(F.col("_run").isNotNull(), F.struct("_run", "codes"))

    def build(part: Part, d: DataFrame) -> DataFrame:
        return part.running(d, {"_now": ("max", run, True)}).where(F.col("_kind") == 1)

    found = per_series(walk, order, build)
    return found.select(*df.columns, F.coalesce("_now.codes", F.array().cast("array<string>")).alias(name))


def interval_flags(
    df: DataFrame,
    faults: DataFrame,
    series: Series,
    codes: Sequence[str],
    start: str = "activated_at",
    end: str = "fixed_at",
    code: str = "code",
    prefix: str = "fault_",
    any_name: str = "fault_any",
) -> DataFrame:
    """0/1 per code asked for, and for any of them: some interval of the same key covers the row's time, both ends included.

    For few codes starts, rows and ends are walked in time order and open intervals are counted, a running sum for each
    code; more than COUNTED_CODES are looked up in `open_codes`, whose plan is as wide for any number of codes. An
    interval without an end stays open.
    """
    if len(codes) > COUNTED_CODES:
        found = open_codes(df, faults.where(F.col(code).isin(*codes)), series, start, end, code, "_codes")
        flags = [F.array_contains("_codes", c).cast("int").alias(prefix + c) for c in codes]
        return found.select(*df.columns, *flags, (F.size("_codes") > 0).cast("int").alias(any_name))
    keys = series.keys
    at = ordinal(df, series.time)
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in (start, end))
    known = faults.where(F.col(code).isin(*codes) & (last.isNull() | (last >= first)))
    # equal endpoints of a key become one row before anything is shuffled
    deltas = [
        F.sum(F.when(F.col(code) == c, F.col("_step")).otherwise(0)).alias(f"_d{i}")
        for i, c in enumerate(codes)
    ]

    def ends(moment: Column, kind: int, step: int) -> DataFrame:
        points = known.select(*keys, code, moment.alias("_at"), F.lit(kind).alias("_kind"), F.lit(step).alias("_step"))
        points = points.where(F.col("_at").isNotNull())
        return points.groupBy(*keys, "_at", "_kind").agg(*deltas)

    walk = (
        df.withColumns({"_at": at, "_kind": F.lit(1)})
        .unionByName(ends(first, 0, 1), allowMissingColumns=True)
        .unionByName(ends(last, 2, -1), allowMissingColumns=True)
    )
    # the rows' own measure serves: ends of intervals only add to them
    order = replace(series, time="_at", ties=("_kind",), finer=())

    def build(part: Part, d: DataFrame) -> DataFrame:
        step = {f"_open{i}": ("sum", F.coalesce(F.col(f"_d{i}"), F.lit(0)), True) for i in range(len(codes))}
        return part.running(d, step).where(F.col("_kind") == 1)

    counted = per_series(walk, order, build)
    flags = {c: (F.col(f"_open{i}") > 0).cast("int").alias(prefix + c) for i, c in enumerate(codes)}
    some = F.lit(False)
    for i in range(len(codes)):
        some = some | (F.col(f"_open{i}") > 0)
    return counted.select(*df.columns, *flags.values(), some.cast("int").alias(any_name))


def pre_event_stats(
    df: DataFrame,
    events: DataFrame,
    series: Series,
    signals: Sequence[str],
    event_id: str,
    event_time: str,
    before_s: float = 1200,
    min_rows: int = 10,
) -> DataFrame:
    """Row count and mean of each signal in `[event - before_s, event)`, per event.

    Time is cut into slots as wide as the look-back, so a window covers the end of one slot and the
    start of the next. Running sums within a slot are read at both window ends: work grows with rows
    plus events, never with their product.
    """
    keys = series.keys
    width = int(before_s * SECOND)
    signals = list(signals)

    slot = F.floor(F.col("_at") / width)
    rows = df.select(*keys, *signals, ordinal(df, series.time).alias("_at"), F.lit(1).alias("_one"), F.lit(1).alias("_kind"))
    rows = rows.where(F.col("_at").isNotNull()).withColumn("_slot", slot)
    moment = ordinal(events, event_time)
    base = events.where(F.col(event_time).isNotNull()).select(*keys, event_id, moment.alias("_to"))
    ends = F.array(
        F.struct(F.col("_to").alias("_at"), F.lit(1).alias("_sign"), F.lit(0).alias("_shift")),
        F.struct((F.col("_to") - width).alias("_at"), F.lit(-1).alias("_sign"), F.lit(0).alias("_shift")),
        # all of the earlier slot: read behind its last row
        F.struct(F.col("_to").alias("_at"), F.lit(1).alias("_sign"), F.lit(1).alias("_shift")),
    )
    probes = base.select(*keys, event_id, F.inline(ends)).withColumn("_slot", slot - F.col("_shift"))
    # probes sort before rows of the same time (rows at the event itself do not count)
    probes = probes.withColumn("_kind", F.lit(0)).drop("_shift")
    walk = rows.unionByName(probes, allowMissingColumns=True)
    order = Series((*keys, "_slot"), "_at", ("_kind",), series.max_rows)
    sums = {"_rows": ("sum", F.coalesce("_one", F.lit(0)), True)}
    for s in signals:
        sums[f"_s_{s}"] = ("sum", F.coalesce(F.col(s), F.lit(0.0)), True)
        sums[f"_c_{s}"] = ("sum", F.col(s).isNotNull().cast("int"), True)
    walked = per_series(walk, order, lambda part, d: part.running(d, sums))
    read = walked.where(F.col("_kind") == 0).select(*keys, event_id, "_sign", *sums)

    def net(name: str) -> Column:
        return F.sum(F.coalesce(F.col(name), F.lit(0)) * F.col("_sign"))

    per_event = read.groupBy(*keys, event_id).agg(
        net("_rows").alias("pre_rows"),
        *[
            F.when(net(f"_c_{s}") > 0, net(f"_s_{s}") / net(f"_c_{s}")).alias(f"{s}_pre_mean")
            for s in signals
        ],
    )
    return per_event.where(F.col("pre_rows") >= min_rows)


def pre_event_zscores(
    stats: DataFrame,
    df: DataFrame,
    signals: Sequence[str],
    by: Sequence[str] = (),
    min_std: float = 1e-9,
) -> DataFrame:
    """Add how far each pre-event mean lies from the mean of `df`, in sample deviations."""
    base = [F.avg(s).alias(f"_m_{s}") for s in signals] + [F.stddev_samp(s).alias(f"_d_{s}") for s in signals]
    if by:
        joined = stats.join(df.groupBy(*by).agg(*base), list(by), "left")
    else:
        whole = df.agg(F.struct(*base).alias("b")).select("b").scalar()  # one row
        joined = stats.withColumn("_b", whole)
        fields = {f"_{k}_{s}": F.col(f"_b._{k}_{s}") for s in signals for k in ("m", "d")}
        joined = joined.withColumns(fields)
    scores = [
        F.when(
            F.col(f"_d_{s}") > min_std, (F.col(f"{s}_pre_mean") - F.col(f"_m_{s}")) / F.col(f"_d_{s}")
        ).alias(f"{s}_z")
        for s in signals
    ]
    return joined.select(*stats.columns, *scores)


def tiles(first: Column, last: Column, levels: int = 44) -> Column:
    """The least array of (level, tile) that covers the tiles first to last of level 0. A tile of level n holds 2^n of
    them and begins at a multiple of that; there are at most two for each level."""

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.ceil(first / size), F.floor((last + 1) / size)
        inside = low < high
        odd = lambda c: F.pmod(c, F.lit(2)) == 1
        tile = lambda c: F.struct(level.alias("level"), c.cast("long").alias("tile"))
        left = F.when(inside & odd(low), F.array(tile(low)))
        right = F.when(inside & odd(high) & ~(odd(low) & (high - low == 1)), F.array(tile(high - 1)))
        none = F.array().cast("array<struct<level:int,tile:bigint>>")
        return F.concat(F.coalesce(left, none), F.coalesce(right, none))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at))


def event_segments(
    df: DataFrame,
    events: DataFrame,
    series: Series,
    event_id: str,
    start: str,
    end: str,
    before_s: float = 1200,
    after_s: float = 600,
    bucket_s: float = 600,
) -> DataFrame:
    """The rows within `[start - before_s, end + after_s]` of each event: one row per event and reading,
    which is what a segment is.

    An event is cut into aligned tiles of `bucket_s` times a power of two, at most two of each size however long it is;
    where no event is long, into tiles of `bucket_s`. A reading joins on its tile of each size that events have; adaptive execution splits a hot tile.
    Both sides are shuffled: the planner takes neither for as large as its tiles make it, and would send one through the driver.
    """
    width = int(bucket_s * SECOND)
    lo = F.unix_micros(F.col(start).cast("timestamp")) - int(before_s * SECOND)
    hi = F.unix_micros(F.col(end).cast("timestamp")) + int(after_s * SECOND)
    spans = events.select(*[F.col(k).alias(f"_e_{k}") for k in series.keys], F.col(event_id).alias("_event"), lo.alias("_lo"), hi.alias("_hi"))
    spans = spans.where(F.col("_hi") >= F.col("_lo"))
    longest = spans.agg(F.max(F.col("_hi") - F.col("_lo"))).first()[0] or 0
    ends = F.floor(F.col("_lo") / width), F.floor(F.col("_hi") / width)
    if longest // width < SHORT:
        cover = F.transform(F.sequence(*ends), lambda t: F.struct(F.lit(0).alias("level"), t.alias("tile")))
    else:
        cover = tiles(*ends, (longest // width + 2).bit_length())
    wanted = spans.select("*", F.inline(cover)).withColumnsRenamed({"level": "_e_level", "tile": "_e_tile"})
    levels = [(0,)] if longest // width < SHORT else wanted.select("_e_level").distinct().collect()  # at most 44, and those that events have
    used = sorted(r[0] for r in levels)
    at = ordinal(df, series.time)
    tile = F.floor(at / width)
    mine = F.array(*[F.struct(F.lit(n).alias("_level"), F.floor(tile / (1 << n)).alias("_tile")) for n in used])
    mine = mine if used else F.array().cast("array<struct<_level:int,_tile:bigint>>")
    rows = df.select("*", at.alias("_at"), F.inline(mine))
    match = (F.col("_level") == F.col("_e_level")) & (F.col("_tile") == F.col("_e_tile"))
    for k in series.keys:
        match = match & (F.col(k) == F.col(f"_e_{k}"))
    match = match & F.col("_at").between(F.col("_lo"), F.col("_hi"))
    return rows.join(wanted.hint("merge"), match, "inner").select(*df.columns, F.col("_event").alias("segment_event"))


def day_slice(df: DataFrame, time: str, day: str) -> DataFrame:
    """Rows of one calendar day; a plain range on the column, so the scan can skip files."""
    lo = F.lit(day).cast("date").cast(df.schema[time].dataType)
    hi = F.date_add(F.lit(day).cast("date"), 1).cast(df.schema[time].dataType)
    return df.where((F.col(time) >= lo) & (F.col(time) < hi))
