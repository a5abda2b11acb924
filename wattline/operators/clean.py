"""Raw text rows to validated readings: names, types, times, ranges and the report about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.config import (
    DURATION_COLUMNS,
    HARD_RANGE_BREACH,
    HEADERS,
    NUMERIC_SIGNALS,
    RANGES,
    REQUIRED_COLUMNS,
    SOFT_RANGE_BREACH,
    TIME_ANOMALY,
    TIME_FORMATS,
    ZERO_IS_MISSING,
    Range,
)
from wattline.functions.scalar import category, check_ranges, number, outside, parse_time, require, seconds_of
from wattline.operators.series import attach

FILE_ORDER = ("_file", "_block", "_row")


def standardize(df: DataFrame, headers: Mapping[str, str] = HEADERS) -> DataFrame:
    """Canonical names, the enable state as 0/1 and running times in seconds; other columns are kept."""
    df = df.withColumnsRenamed(dict(headers))
    made = {}
    if "mcu_enable_state" in df.columns:
        made["mcu_enable_state"] = category("mcu_enable_state")
    durations = [c for c in DURATION_COLUMNS if c in df.columns]
    for c in durations:
        made[f"{c}_s"] = seconds_of(c)
    return df.withColumns(made).drop(*durations) if made else df


def mark_reversals(
    df: DataFrame, time: str, file: str = "_file", block: str = "_block", row: str = "_row", name: str = "_reversed"
) -> DataFrame:
    """True where a row is earlier than the row before it in its file.

    A file is walked split by split; only the last time of each split is carried into the next, so a
    large file is never one task.
    """
    inside = Window.partitionBy(file, block).orderBy(row)
    last = df.groupBy(file, block).agg(F.max_by(F.struct(time), F.col(row)).alias("_end"))
    before = last.select(file, block, F.lag("_end").over(Window.partitionBy(file).orderBy(block)).alias("_carry"))
    df = df.withColumns({"_prev": F.lag(F.struct(time)).over(inside)})
    df = attach(df, before, [file, block])
    previous = F.when(F.col("_prev").isNotNull(), F.col(f"_prev.{time}")).otherwise(F.col(f"_carry.{time}"))
    return df.withColumn(name, F.coalesce(F.col(time) < previous, F.lit(False))).drop("_prev", "_carry")


def parsed(
    df: DataFrame,
    time: str = "timestamp",
    numeric: Sequence[str] = NUMERIC_SIGNALS,
    required: Sequence[str] = REQUIRED_COLUMNS,
    zero_missing: Sequence[str] = ZERO_IS_MISSING,
    time_formats: Sequence[str] = TIME_FORMATS,
) -> DataFrame:
    """Typed columns; unreadable values and placeholder zeros become NULL. Rows are all kept."""
    require(df, required, "raw rows")
    made = {c: number(c) for c in numeric if c in df.columns}
    for c in zero_missing:
        if c in made:
            made[c] = F.nullif(made[c], F.lit(0.0))
    made[time] = parse_time(time, time_formats)
    if "quality_flag" in df.columns:
        made["quality_flag"] = F.coalesce(F.col("quality_flag").try_cast("int"), F.lit(0))
    else:
        made["quality_flag"] = F.lit(0)
    return df.withColumns(made)


def flagged(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Set the time-anomaly bit on rows without a readable time and on rows that run backwards."""
    backwards = F.lit(False)
    if set(FILE_ORDER) <= set(df.columns):
        df = mark_reversals(df, time)
        backwards = F.col("_reversed")
    odd = F.col(time).isNull() | backwards
    mask = F.col("quality_flag").bitwiseOR(F.when(odd, F.lit(TIME_ANOMALY)).otherwise(F.lit(0)))
    return df.withColumn("quality_flag", mask)


def validate(df: DataFrame, time: str = "timestamp", ranges: Mapping[str, Range] = RANGES, **kwargs) -> DataFrame:
    """Parse, flag, drop rows without a time, check ranges."""
    checked = flagged(parsed(df, time, **kwargs), time)
    out = check_ranges(checked.where(F.col(time).isNotNull()), ranges)
    return out.drop("_reversed")


def validation_report(
    checked: DataFrame,
    keys: Sequence[str] = ("dt", "vehicle_id"),
    time: str = "timestamp",
    ranges: Mapping[str, Range] = RANGES,
) -> DataFrame:
    """Per file, from the rows as `flagged` returns them: bad and reversed times, duplicates, breaches in
    total and per signal, NULL rates. One pass."""
    good = F.col(time).isNotNull()
    limits = {c: r for c, r in ranges.items() if c in checked.columns}
    soft = {c: F.count_if(good & outside(F.col(c), r.soft)) for c, r in limits.items()}
    hard = {c: F.count_if(good & outside(F.col(c), r.hard)) for c, r in limits.items()}
    body = [c for c in checked.columns if c not in (*keys, *FILE_ORDER, "_reversed")]
    reversed_rows = F.count_if("_reversed") if "_reversed" in checked.columns else F.lit(0).cast("long")

    def rate(c: str):
        gone = F.col(c).isNull()
        if c in limits:
            gone = gone | outside(F.col(c), limits[c].hard)
        return F.avg(F.when(good, gone.cast("double")))

    def total(parts):
        out = F.lit(0).cast("long")
        for p in parts.values():
            out = out + p
        return out

    def per_signal(parts):
        cells = [F.struct(n.alias("n"), F.lit(c).alias("column")) for c, n in parts.items()]
        top = F.slice(F.reverse(F.array_sort(F.array(*cells))), 1, 10)
        return F.map_from_entries(F.transform(top, lambda s: F.struct(s["column"], s["n"])))

    return checked.groupBy(*keys).agg(
        F.count_if(good).alias("row_count_after_validation"),
        # rows beyond the first at each time; rows without a time count as one time
        (F.count(F.lit(1)) - F.count_distinct(time) - F.max(F.when(~good, 1).otherwise(0))).alias("duplicate_timestamps"),
        F.count_if(~good).alias("bad_timestamps"),
        reversed_rows.alias("time_reversal_rows"),
        total(soft).alias("soft_range_breaches"),
        total(hard).alias("hard_range_breaches"),
        (per_signal(soft) if soft else F.lit(None)).alias("soft_breaches_by_col"),
        (per_signal(hard) if hard else F.lit(None)).alias("hard_breaches_by_col"),
        F.struct(*[rate(c).alias(c) for c in body]).alias("null_rates"),
    )


def breach_counts(df: DataFrame, mask: str = "quality_flag") -> DataFrame:
    """Rows per quality verdict."""
    bits = F.coalesce(F.col(mask), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bits.bitwiseAND(SOFT_RANGE_BREACH) != 0).alias("soft"),
        F.count_if(bits.bitwiseAND(HARD_RANGE_BREACH) != 0).alias("hard"),
    )
