"""Trip rows, daily rows, manifests and data-quality reports. All combine before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.scalar import has_bits


def trip_rows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    vehicle: str | None = None,
    level: str | None = None,
    fault: str | None = None,
    peaks: Sequence[str] = (),
    power: str | None = None,
    min_rows: int = 60,
    ties: Sequence[str] = (),
    step_s: float = 1.0,
    level_name: str = "soc",
) -> DataFrame:
    """One row per trip: extent, rows, change of `level`, fault seconds, peaks and energy."""
    out = [
        F.min(time).alias("trip_start_ts"),
        F.max(time).alias("trip_end_ts"),
        F.count(F.lit(1)).alias("rows"),
    ]
    if vehicle:
        out.append(F.min(vehicle).alias(vehicle))
    if level:
        # a NULL first or last reading is the answer, too; a plain time keeps this a hash aggregation
        order = F.struct(time, *ties) if ties else F.col(time)
        out.append(F.min_by(level, order).alias(f"{level_name}_start"))
        out.append(F.max_by(level, order).alias(f"{level_name}_end"))
    if fault:
        out.append(F.sum(F.coalesce(F.col(fault), F.lit(0))).cast("long").alias("fault_seconds"))
    out += [F.max(p).alias(f"{p}_max") for p in peaks]
    if power:
        out.append((F.sum(F.coalesce(F.col(power), F.lit(0.0))) * step_s / 3600).alias("energy_kwh_proxy"))
    trips = df.groupBy(*keys).agg(*out).where(F.col("rows") >= min_rows)
    start, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("trip_start_ts", "trip_end_ts"))
    added = {"duration_s": F.floor((end - start) / 1_000_000)}
    if level:
        added[f"{level_name}_delta"] = F.col(f"{level_name}_end") - F.col(f"{level_name}_start")
    return trips.withColumns(added)


def daily_rows(
    silver: DataFrame,
    gold: DataFrame,
    trip_table: DataFrame,
    drop_mask: int,
    min_rows: int = 60,
    keys: Sequence[str] = ("dt", "vehicle_id"),
    flag: str = "quality_flag",
    trip: str = "trip_id",
) -> DataFrame:
    """One row per file, also where the quality filter left nothing."""
    keys = list(keys)
    kept = ~has_bits(flag, drop_mask) & F.col(trip).isNotNull()
    days = silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.count_if(kept).alias("rows_after_quality_filter")
    )
    windows = gold.groupBy(*keys, trip).agg(F.count(F.lit(1)).alias("_n"))
    windows = windows.groupBy(*keys).agg(
        F.sum("_n").alias("window_feature_rows"), F.count(F.lit(1)).alias("trip_groups_processed")
    )
    counted = trip_table.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"))
    out = days.join(windows, keys, "left").join(counted, keys, "left")
    zero = ["window_feature_rows", "trip_groups_processed", "trip_count"]
    out = out.fillna(0, zero)
    before, after = F.col("silver_rows"), F.col("rows_after_quality_filter")
    return out.select(
        *keys,
        "silver_rows",
        "rows_after_quality_filter",
        (before - after).alias("dropped_rows"),
        ((before - after) / F.greatest(before, F.lit(1))).alias("drop_pct"),
        "window_feature_rows",
        "trip_count",
        (F.col("window_feature_rows") >= min_rows).cast("int").alias("has_enough_rows"),
        "trip_groups_processed",
        F.col("trip_groups_processed").alias("window_parts_written"),
        (after - F.col("window_feature_rows")).alias("dropped_unrealistic_target_rows"),
        F.when(after == 0, "empty_after_quality_filter").otherwise("success").alias("status"),
    )


def ingest_manifest(
    raw: DataFrame,
    silver: DataFrame,
    faults: DataFrame | None = None,
    keys: Sequence[str] = ("dt", "vehicle_id"),
    time: str = "timestamp",
) -> DataFrame:
    """One row per file: row counts, data extent, duplicate ticks, trips and faults."""
    keys = list(keys)
    left = raw.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.min(time).alias("data_start_ts"),
        F.max(time).alias("data_end_ts"),
    )
    # two narrow aggregations: distinct counts of two columns at once would triple the rows
    active = F.sum("fault_any") if "fault_any" in silver.columns else F.lit(0)
    per_trip = silver.groupBy(*keys, "trip_id").agg(F.count(F.lit(1)).alias("_n"), active.alias("_f"))
    right = per_trip.groupBy(*keys).agg(
        F.sum("_n").alias("silver_rows"),
        F.count("trip_id").alias("num_trips"),
        F.coalesce(F.sum("_f"), F.lit(0)).cast("long").alias("fault_active_rows"),
    )
    per_tick = silver.groupBy(*keys, time).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    doubled = per_tick.groupBy(*keys).agg(F.sum("_extra").alias("silver_duplicate_timestamps"))
    right = right.join(doubled, keys, "left")
    out = left.join(right, keys, "left")
    if faults is None:
        return out.withColumn("num_fault_events", F.lit(0).cast("long"))
    events = faults.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_fault_events"))
    return out.join(events, keys, "left").fillna(0, ["num_fault_events"])


def gold_totals(daily: DataFrame) -> DataFrame:
    """Totals over all files of a run."""
    sums = ["silver_rows", "rows_after_quality_filter", "window_feature_rows", "trip_count"]
    return daily.agg(
        F.count(F.lit(1)).alias("files"),
        *[F.sum(c).alias(c) for c in sums],
        F.sum("dropped_unrealistic_target_rows").alias("dropped_unrealistic_target_rows"),
        F.count_if(F.col("status") != "success").alias("empty_files"),
    )


def trip_extent_stats(df: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), (F.max(level) - F.min(level)).alias("level_range")
    )


def micro_trips(df: DataFrame, keys: Sequence[str], level: str, min_rows: int = 60, min_range: float = 3.0) -> DataFrame:
    """The trips that are too short or whose level hardly changes."""
    keep = (F.col("rows") >= min_rows) & (F.col("level_range") >= min_range)
    return trip_extent_stats(df, keys, level).where(~F.coalesce(keep, F.lit(False)))


def filter_micro_trips(
    df: DataFrame, keys: Sequence[str], level: str, min_rows: int = 60, min_range: float = 3.0
) -> DataFrame:
    """Rows of the other trips."""
    keep = (F.col("rows") >= min_rows) & (F.col("level_range") >= min_range)
    good = trip_extent_stats(df, keys, level).where(keep).select(*keys)
    return df.join(good, list(keys), "left_semi")


def unpivoted(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, value) with every column as a double."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "feature", "value")


def constant_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per feature: distinct values, extremes, mean, deviation and share of zeros; constant ones first.

    Values are counted per (feature, value) first, so a feature's distinct values need not meet in
    one task.
    """
    columns = [c for c in columns if c in df.columns]
    long = unpivoted(df, columns).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    values = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"))
    distinct = values.groupBy("feature").agg(F.count("value").alias("n_unique"))
    stats = long.groupBy("feature").agg(
        F.count("value").alias("_present"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.avg((F.col("value") == 0).cast("double")).alias("_zero"),
    )
    empty = F.col("_present") == 0
    out = stats.join(distinct, "feature").select(
        "feature",
        F.when(empty, "all_nan").otherwise("ok").alias("status"),
        F.when(~empty, F.col("n_unique")).alias("n_unique"),
        "min",
        "max",
        "mean",
        "std",
        F.when(empty, F.lit(1.0)).otherwise(F.col("_zero")).alias("zero_pct"),
    )
    near = (F.coalesce("std", F.lit(0.0)) < 1e-6) & (F.coalesce("n_unique", F.lit(0)) <= 2)
    return out.withColumns(
        {"is_constant": F.coalesce(F.col("n_unique") == 1, F.lit(False)), "is_near_constant": near}
    ).orderBy(F.col("is_constant").desc(), F.col("is_near_constant").desc(), F.col("zero_pct").desc(), "feature")


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column, as one row per column from a single pass."""
    names = list(columns or df.columns)
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    return one.unpivot([], names, "column", "null_rate")
