"""Trips: sessions cut at long gaps, numbered per vehicle, with a minimum length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.config import GAP_INSERTED, TripConfig
from wattline.operators.series import Part, Series, attach, measure, ordinal, per_series

SECOND = 1_000_000


def _number(part: Part, df: DataFrame, gap_break: int, step_us: int) -> DataFrame:
    """Add `_prev`, the time of the row before, and `_seq`, the session's number in its series."""
    at = ordinal(df, part.series.time)
    df = part.running(df, {"_prev": ("max", at, False)})
    return part.running(df, {"_seq": ("sum", _one(_far(at, gap_break, step_us)), True)})


def _far(at: Column, gap_break: int, step_us: int) -> Column:
    return F.col("_prev").isNull() | (at - F.col("_prev") >= (gap_break + 1) * step_us)


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def sessions(
    df: DataFrame,
    series: Series,
    gap_break: int,
    step_s: float = 1,
    min_rows: int = 1,
    name: str = "trip_id",
) -> DataFrame:
    """Session id of each row of an irregular series; too short sessions get NULL, their number is spent.

    A session ends where at least `gap_break` steps are missing before the next row.
    """
    step_us = int(step_s * SECOND)

    def build(part: Part, d: DataFrame) -> DataFrame:
        d = part.group_count(_number(part, d, gap_break, step_us), "_seq", "_rows")
        named = F.when(F.col("_rows") >= min_rows, trip_name(series.keys[-1], "_seq"))
        return d.withColumn(name, named).drop("_prev", "_seq", "_rows")

    return per_series(df, series, build)


def trip_name(vehicle: str, number: str | Column) -> Column:
    return F.format_string("%s_%06d", F.col(vehicle).cast("string"), F.col(number) if isinstance(number, str) else number)


def trips(
    df: DataFrame,
    day: str = "dt",
    vehicle: str = "vehicle_id",
    time: str = "timestamp",
    flag: str = "quality_flag",
    step_s: int = 1,
    config: TripConfig = TripConfig(),
    state: DataFrame | None = None,
    check_file_gap: bool = False,
    count_padding: bool = True,
    series: Series | None = None,
    real: DataFrame | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Add `trip_id` to gridded rows. Each (day, vehicle) is one file; a trip open at the end of a file
    goes on in the vehicle's next file. `state` holds one row per vehicle as `trip_state` returns it.

    Of a gap that ends a trip all but the last rows a break needs still belong to it (padding). Gap rows
    at the end of a file are padding of its last trip, those at its start of the trip that is open there;
    as long as a break, they end it.

    `real` may give the real rows' keys and times, from before the grid was made: which trips a file
    has follows from them and the ends of the grid (`bounds`, as `resample.grid_bounds` gives them), so
    the grid is not computed twice. `series` may carry the files' row counts, measured on the same rows. `check_file_gap` also ends a trip when the time between two files
    is a break. With `count_padding=False` only real rows count towards the minimum length.
    """
    step = step_s * SECOND
    present = F.coalesce(F.col(flag), F.lit(0)).bitwiseAND(GAP_INSERTED) == 0
    if real is None:
        real = df.where(present).select(day, vehicle, time)
    series = series or measure(df, Series((day, vehicle), time))
    if bounds is None:
        bounds = df.groupBy(*series.keys).agg(F.min(ordinal(df, time)).alias("_lo"), F.max(ordinal(df, time)).alias("_hi"))
    found = file_sessions(real, series, step, config, count_padding, bounds)
    files = file_offsets(found, series, step, config, state, check_file_gap)

    def build(part: Part, d: DataFrame) -> DataFrame:
        at = ordinal(d, time)
        d = part.running(d, {"_prev": ("max", F.when(present, at), False)})
        starts = present & _far(at, config.gap_break, step)
        d = part.running(d, {"_seq": ("sum", _one(starts), True)})
        padded = F.col("_prev").isNotNull() & (at - F.col("_prev") <= (config.gap_break - 1) * step)
        d = d.withColumns({"_seq": F.when(present | padded, F.col("_seq")), "_early": F.col("_prev").isNull() & ~present})
        if count_padding:
            return part.group_count(d, "_seq", "_rows").drop("_prev")
        # padding rows take the count of the real rows before them
        d = part.group_count(d.withColumn("_real", F.when(present, F.col("_seq"))), "_real", "_rows")
        d = part.running(d, {"_last": ("max", F.when(present, F.struct("_seq", "_rows")), True)})
        return d.withColumn("_rows", F.col("_last._rows")).drop("_prev", "_real", "_last")

    numbered = per_series(df, series, build)
    wanted = files.select(*series.keys, "_base", "_cont", "_lead", "_ended", "_first_rows", "_first_at")
    joined = numbered.join(wanted, list(series.keys), "left")
    # gap rows before a file's first real row: of the trip open there
    near_end = F.col("_first_at") - F.col("_lead") * step + (config.gap_break - 1) * step > ordinal(df, time)
    early = F.when(F.col("_cont") == 1, 1).when(F.col("_ended") & near_end, 0)
    lead = F.when(F.lit(count_padding) & (F.col("_cont") == 1), F.col("_lead")).otherwise(0)
    early_rows = F.when(F.col("_cont") == 1, F.col("_first_rows") + lead).when(F.lit(count_padding), config.gap_break - 1).otherwise(0)
    joined = joined.withColumns({
        "_rows": F.when(F.col("_early"), early_rows).otherwise(F.col("_rows") + F.when(F.col("_seq") == 1, lead).otherwise(0)),
        "_seq": F.when(F.col("_early"), early).otherwise(F.col("_seq")) + F.col("_base"),
    })
    long_enough = F.col("_seq").isNotNull() & (F.col("_rows") >= config.min_rows)
    named = F.when(long_enough, trip_name(vehicle, "_seq"))
    return joined.withColumn("trip_id", named).drop("_seq", "_rows", "_early", *[c for c in wanted.columns if c not in series.keys])


def file_sessions(
    real: DataFrame, series: Series, step: int, config: TripConfig, count_padding: bool, bounds: DataFrame | None = None
) -> DataFrame:
    """The sessions of each file, from its real rows and the ends of its grid: first and last time, rows, and
    whether the session is long enough and, if it is the last, open at the file's end. A first session that
    goes on from the file before counts the gap rows in front of it, too."""
    at = ordinal(real, series.time)
    numbered = per_series(real, series, lambda part, d: _number(part, d, config.gap_break, step))
    fresh = F.col("_prev").isNull() | (at > F.col("_prev"))
    found = numbered.groupBy(*series.keys, "_seq").agg(
        F.min(at).alias("_start"), F.max(at).alias("_end"), F.count_if(fresh).alias("_real")
    )
    if bounds is None:
        found = found.withColumns({"_lo": F.lit(None).cast("long"), "_hi": F.lit(None).cast("long")})
    else:
        found = attach(found, bounds, series.keys)
    file = Window.partitionBy(*series.keys)
    last = F.col("_seq") == F.max("_seq").over(file)
    tail = F.when(last, F.greatest(F.coalesce(F.ceil((F.col("_hi") - F.col("_end")) / step), F.lit(0)), F.lit(0)))
    lead = F.greatest(F.coalesce(F.floor((F.min("_start").over(file) - F.col("_lo")) / step), F.lit(0)), F.lit(0))
    found = found.withColumns({"_tail": tail, "_lead": lead})
    padding = F.least(F.coalesce("_tail", F.lit(config.gap_break - 1)), F.lit(config.gap_break - 1))
    ticks = F.floor((F.col("_end") - F.col("_start")) / step) + 1 + padding
    found = found.withColumn("_rows", ticks if count_padding else F.col("_real"))
    before = F.when((F.col("_seq") == 1) & (F.col("_lead") < config.gap_break) & F.lit(count_padding), F.col("_lead")).otherwise(0)
    long_enough = F.col("_rows") + before >= config.min_rows
    return found.withColumn("_open", long_enough & (F.coalesce("_tail", F.lit(0)) < config.gap_break)).drop("_lo", "_hi")


def file_offsets(
    found: DataFrame, series: Series, step: int, config: TripConfig, state: DataFrame | None, check_file_gap: bool
) -> DataFrame:
    """One row per file: `_base` is what to add to its session numbers, `_cont` is 1 where its first
    session continues the trip open at the end of the vehicle's previous file."""
    day, vehicle = series.keys
    files = found.groupBy(*series.keys).agg(
        F.max("_seq").alias("_sessions"),
        F.max_by("_open", "_seq").alias("_last_open"),
        F.max_by("_start", "_seq").alias("_newest"),
        F.min("_start").alias("_first_at"),
        F.max("_end").alias("_last_at"),
        F.min("_lead").alias("_lead"),
        F.min_by("_rows", "_seq").alias("_first_rows"),
    )
    order = Window.partitionBy(vehicle).orderBy(day)
    open_before = F.lag("_last_open").over(order)
    end_before = F.lag("_last_at").over(order)
    start = F.lit(0).cast("long")
    if state is not None:
        known = state.select(
            F.col("vehicle_id").alias(vehicle),
            F.col("trip_seq").alias("_state_seq"),
            F.col("open_trip_id").isNotNull().alias("_state_open"),
            F.unix_micros(F.col("last_ts").cast("timestamp")).alias("_state_at"),
            F.unix_micros(F.col("open_trip_start_ts").cast("timestamp")).alias("_state_start"),
        )
        files = files.join(known, vehicle, "left")
        first = F.row_number().over(order) == 1
        open_before = F.when(first, F.col("_state_open")).otherwise(open_before)
        end_before = F.when(first, F.col("_state_at")).otherwise(end_before)
        start = F.coalesce(F.col("_state_seq"), F.lit(0)).cast("long")
    else:
        files = files.withColumn("_state_start", F.lit(None).cast("long"))
    goes_on = F.coalesce(open_before, F.lit(False))
    if check_file_gap:
        near = F.col("_first_at") - end_before < (config.gap_break + 1) * step
        goes_on = goes_on & F.coalesce(near, F.lit(False))
    here = F.col("_lead") < config.gap_break
    files = files.withColumns({"_cont": _one(goes_on & here), "_ended": goes_on & ~here})
    upto_last = order.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("_sessions") - F.col("_cont")).over(upto_last), F.lit(0))
    return files.withColumn("_base", start + earlier - F.col("_cont"))


def trip_states(
    real: DataFrame,
    days: Sequence[str] | None = None,
    day: str = "dt",
    vehicle: str = "vehicle_id",
    time: str = "timestamp",
    step_s: int = 1,
    config: TripConfig = TripConfig(),
    state: DataFrame | None = None,
    check_file_gap: bool = False,
    count_padding: bool = True,
    series: Series | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """The state after each of the days (of those with files, if not given), one row per vehicle and day
    `as_of`: counter, open trip, when that trip began, last time, and `dt`, the file it comes from. Vehicles
    without a file keep the row they had, first the one in `state`.

    Computed from the keys and times of the real rows and the ends of their grids.
    """
    step = step_s * SECOND
    series = series or measure(real, Series((day, vehicle), time))
    found = file_sessions(real, series, step, config, count_padding, bounds)
    files = file_offsets(found, series, step, config, state, check_file_gap)
    order = Window.partitionBy(vehicle).orderBy(day)
    # a trip that spans files began in the first of them: skip files it runs right through
    through = (F.col("_sessions") == 1) & (F.col("_cont") == 1)
    began = F.last(F.when(~through, F.col("_newest")), ignorenulls=True).over(order)
    began = F.coalesce(began, F.col("_state_start"), F.col("_newest"))
    after = files.select(
        F.col(vehicle).alias("vehicle_id"),
        (F.col("_base") + F.col("_sessions")).alias("trip_seq"),
        F.when(F.col("_last_open"), trip_name(vehicle, F.col("_base") + F.col("_sessions"))).alias("open_trip_id"),
        F.when(F.col("_last_open"), F.timestamp_micros(began)).alias("open_trip_start_ts"),
        F.timestamp_micros("_last_at").alias("last_ts"),
        F.col(day).cast("string").alias("dt"),
    )
    if days is None:
        return after.withColumn("as_of", F.col("dt"))
    if state is not None:
        after = after.unionByName(state.select(*after.columns))
    until = F.lead("dt").over(Window.partitionBy("vehicle_id").orderBy("dt"))
    listed = F.filter(F.array(*[F.lit(d) for d in sorted(days)]), lambda d: (d >= F.col("dt")) & (F.col("_until").isNull() | (d < F.col("_until"))))
    return after.withColumn("_until", until).withColumn("as_of", F.explode(listed)).drop("_until")


def trip_state(real: DataFrame, *args, state: DataFrame | None = None, **options) -> DataFrame:
    """One row per vehicle after its last file, as `trip_states` gives it. Vehicles without a new file keep
    the row they had in `state`."""
    states = trip_states(real, None, *args, state=state, **options)
    last = states.groupBy("vehicle_id").agg(F.max_by(F.struct(*states.columns), "as_of").alias("f"))
    fresh = last.select("f.*").drop("as_of")
    if state is None:
        return fresh
    return fresh.unionByName(state.join(fresh, "vehicle_id", "left_anti"), allowMissingColumns=True)


def spans(
    df: DataFrame,
    series: Series,
    gap_s: float,
    min_rows: int = 1,
) -> DataFrame:
    """Cluster the given rows: a span ends where the next row is more than `gap_s` seconds away."""
    limit = int(gap_s * SECOND)

    def build(part: Part, d: DataFrame) -> DataFrame:
        at = ordinal(d, series.time)
        d = part.running(d, {"_prev": ("max", at, False)})
        brk = F.when(F.col("_prev").isNull() | (at - F.col("_prev") > limit), 1).otherwise(0)
        return part.running(d, {"span": ("sum", brk.cast("long"), True)}).drop("_prev")

    marked = per_series(df, series, build)
    return (
        marked.groupBy(*series.keys, "span")
        .agg(
            F.min(series.time).alias("span_start"),
            F.max(series.time).alias("span_end"),
            F.count(F.lit(1)).alias("rows"),
        )
        .where(F.col("rows") >= min_rows)
    )


def rising_spans(
    df: DataFrame, series: Series, signal: str, rise: float = 0.05, gap_s: float = 5, min_rows: int = 3
) -> DataFrame:
    """Spans of rows whose signal rose by more than `rise` since the row before."""

    def build(part: Part, d: DataFrame) -> DataFrame:
        return part.frames(
            d,
            lambda x, s: x.withColumn("_rise", F.col(signal) - F.lag(signal).over(s.window())),
            back=1,
        )

    series = series if series.measured else measure(df, series)
    rising = per_series(df, series, build).where(F.col("_rise") > rise).drop("_rise")
    return spans(rising, series, gap_s, min_rows)
