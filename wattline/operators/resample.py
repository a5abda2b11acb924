"""Regular time grid: collapse duplicate times, insert missing ticks, fill within limits.

All look-ups are made on real rows, before missing ticks exist: the last reading at or before a row and,
for interpolated signals, the first one after it. Each real row then unfolds into the ticks up to the
next real row. Time is cut into chunks, so no task holds more than a chunk of a series; a chunk also
reads the rows of its neighbours within the longest fill limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.config import (
    COUNTER_SIGNALS,
    FAST_SIGNALS,
    FORWARD_FILLED,
    GAP_INSERTED,
    INTERPOLATED_FAST,
    SLOW_SIGNALS,
    STATUS_SIGNALS,
    ResampleConfig,
)
from wattline.operators.series import ordinal

CHUNK_TICKS = 21_600


def collapse_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    flag: str | None = "quality_flag",
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key and time: numbers averaged, other columns their last non-NULL value in `order`,
    the quality mask OR-ed."""
    by = (*keys, time)
    out = []
    for field in df.schema.fields:
        name = field.name
        if name in by or name in order:
            continue
        if name == flag:
            out.append(F.bit_or(F.coalesce(F.col(name), F.lit(0))).alias(name))
        elif isinstance(field.dataType, T.NumericType):
            out.append(F.avg(name).alias(name))
        elif order:
            seen = F.when(F.col(name).isNotNull(), F.struct(*order))
            out.append(F.max_by(name, seen).alias(name))
        else:
            out.append(F.max(name).alias(name))
    return df.groupBy(*by).agg(*out)


def resample(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "timestamp",
    flag: str = "quality_flag",
    config: ResampleConfig = ResampleConfig(),
    fast: Sequence[str] = FAST_SIGNALS,
    slow: Sequence[str] = SLOW_SIGNALS,
    status: Sequence[str] = STATUS_SIGNALS,
    counter: Sequence[str] = COUNTER_SIGNALS,
    align: str = "exact",
    order: Sequence[str] = (),
    chunk_ticks: int = CHUNK_TICKS,
) -> DataFrame:
    """Every tick from the first to the last row of each key, with bounded fills and quality bits.

    `align="exact"` keeps only rows whose time is a tick; `align="floor"` moves rows to their tick first.
    """
    if align not in ("exact", "floor"):
        raise ValueError(f"align must be exact or floor, not {align}")
    step = config.step_s * 1_000_000
    if flag not in df.columns:
        df = df.withColumn(flag, F.lit(0))
    kind = df.schema[time].dataType
    df = df.withColumn("_us", ordinal(df, time)).where(F.col("_us").isNotNull())
    bounds = df.groupBy(*keys).agg(
        F.floor(F.min("_us") / step).alias("_lo"),
        (F.floor if align == "floor" else F.ceil)(F.max("_us") / step).alias("_hi"),
    )
    if align == "exact":
        df = df.where(F.col("_us") % step == 0)
    ticked = df.withColumn("_t", F.floor(F.col("_us") / step)).drop("_us", time)
    real = collapse_duplicates(ticked, keys, "_t", flag, order)
    out = _fill(real, bounds, keys, flag, config, _present(real, fast, slow, status, counter), chunk_ticks)
    stamp = F.timestamp_micros(F.col("_t") * step)
    return out.withColumn(time, stamp.cast(kind)).drop("_t")


def grid_bounds(
    df: DataFrame, keys: Sequence[str], time: str = "timestamp", step_s: int = 1, align: str = "exact"
) -> DataFrame:
    """First and last tick of each key's grid, as `_lo` and `_hi` in microseconds."""
    step = step_s * 1_000_000
    at = ordinal(df, time)
    last = F.floor if align == "floor" else F.ceil
    return df.where(at.isNotNull()).groupBy(*keys).agg(
        (F.floor(F.min(at) / step) * step).cast("long").alias("_lo"), (last(F.max(at) / step) * step).cast("long").alias("_hi")
    )


def real_ticks(
    df: DataFrame, keys: Sequence[str], time: str = "timestamp", step_s: int = 1, align: str = "exact"
) -> DataFrame:
    """Keys and tick times of the rows a grid is built on."""
    step = step_s * 1_000_000
    at = ordinal(df, time)
    rows = df.where(at.isNotNull() if align == "floor" else at % step == 0)
    stamp = F.timestamp_micros((F.floor(at / step) * step).cast("long"))
    return rows.select(*keys, stamp.cast(df.schema[time].dataType).alias(time))


def _present(df: DataFrame, fast, slow, status, counter) -> dict[str, list[str]]:
    have = set(df.columns)
    classes = {"fast": fast, "slow": slow, "status": status, "counter": counter}
    return {c: [s for s in names if s in have] for c, names in classes.items()}


def _fill(
    real: DataFrame,
    bounds: DataFrame,
    keys: Sequence[str],
    flag: str,
    config: ResampleConfig,
    classes: dict[str, list[str]],
    chunk_ticks: int,
) -> DataFrame:
    fast = classes["fast"]
    limit = {
        "fast": config.fast_limit_s // config.step_s,
        "slow": config.slow_limit_s // config.step_s,
        "status": config.status_limit_s // config.step_s,
        "counter": config.slow_limit_s // config.step_s,
    }
    used = [limit[c] for c, names in classes.items() if names]
    back, ahead = max(used, default=0), limit["fast"] if fast else 0
    size = max(chunk_ticks, back, ahead, 1)

    own = F.floor(F.col("_t") / size)
    targets = F.array_compact(
        F.array(
            own,
            F.when(F.col("_t") >= (own + 1) * size - back, own + 1),
            F.when(F.col("_t") < own * size + ahead, own - 1),
        )
    )
    rows = (
        real.withColumn("_own", own)
        .withColumn("_chunk", F.explode(targets))
        .withColumns({"_real": F.lit(1), "_stop": F.lit(None).cast("long")})
    )
    # one marker per chunk of the grid: where its ticks begin and end
    starts = bounds.withColumn(
        "_chunk", F.explode(F.sequence(F.floor(F.col("_lo") / size), F.floor(F.col("_hi") / size)))
    )
    markers = starts.select(
        *keys,
        "_chunk",
        F.col("_chunk").alias("_own"),
        F.greatest("_lo", F.col("_chunk") * size).alias("_t"),
        F.least(F.col("_hi") + 1, (F.col("_chunk") + 1) * size).alias("_stop"),
        F.lit(0).alias("_real"),
    )
    both = rows.unionByName(markers, allowMissingColumns=True)

    part = Window.partitionBy(*keys, "_chunk")
    walk = part.orderBy("_t", "_real")
    sofar = walk.rowsBetween(Window.unboundedPreceding, 0)

    def reading(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.struct("_t", F.col(name).alias("v")))

    filled = [s for names in classes.values() for s in names]
    both = both.select(
        "*",
        F.lead("_t").over(walk).alias("_next"),
        F.last("_stop", ignorenulls=True).over(sofar).alias("_until"),
        *[F.last(reading(s), ignorenulls=True).over(sofar).alias(f"_p_{s}") for s in filled],
    )
    if fast:
        # a tick may be `limit` after its last reading, and the next one `limit` after the tick
        later = part.orderBy("_t").rangeBetween(1, 2 * limit["fast"])
        both = both.select(
            "*", *[F.first(reading(s), ignorenulls=True).over(later).alias(f"_n_{s}") for s in fast]
        )
    end = F.least(F.coalesce("_next", "_until"), F.col("_until")) - 1
    ticks = (
        both.where((F.col("_own") == F.col("_chunk")) & (end >= F.col("_t")))
        .withColumn("_k", F.explode(F.sequence(F.col("_t"), end)))
        .withColumn("_here", (F.col("_k") == F.col("_t")) & (F.col("_real") == 1))
    )

    values, fast_fills, held_fills = {}, [], []
    for cls, names in classes.items():
        for s in names:
            now = F.when(F.col("_here"), F.col(s))
            before, age = F.col(f"_p_{s}"), F.col("_k") - F.col(f"_p_{s}._t")
            if cls == "fast":
                after = F.col(f"_n_{s}")
                can = now.isNull() & (age <= limit[cls]) & (after["_t"] - F.col("_k") <= limit[cls])
                slope = (after["v"] - before["v"]) / (after["_t"] - before["_t"])
                fill = before["v"] + slope * age
                fast_fills.append(F.coalesce(can, F.lit(False)))
            else:
                can = now.isNull() & (age <= limit[cls])
                fill = before["v"]
                held_fills.append(F.coalesce(can, F.lit(False)))
            values[s] = F.when(now.isNotNull(), now).when(can, fill).alias(s)

    mask = F.when(F.col("_here"), F.coalesce(F.col(flag), F.lit(0))).otherwise(F.lit(GAP_INSERTED))
    for bit, fills in ((INTERPOLATED_FAST, fast_fills), (FORWARD_FILLED, held_fills)):
        if fills:
            mask = mask.bitwiseOR(F.when(_any(fills), F.lit(bit)).otherwise(F.lit(0)))

    rest = [c for c in real.columns if c not in (*keys, "_t", flag, *values)]
    return ticks.select(
        *keys,
        F.col("_k").alias("_t"),
        *values.values(),
        *[F.when(F.col("_here"), F.col(c)).alias(c) for c in rest],
        mask.cast("int").alias(flag),
    )


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
