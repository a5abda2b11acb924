"""Rows worth a look: readings that contradict each other, sudden level changes, trip extents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.scalar import quiet_flag
from wattline.operators.series import MAX_ROWS, Series, positions


def contradictions(
    df: DataFrame,
    speed: str = "motor_speed_rpm",
    power: str = "output_power_kw",
    current: str = "battery_current_a",
    min_speed: float = 300,
    still: float = 0.1,
) -> DataFrame:
    """Rows that move although power or current is about zero."""
    idle = (F.abs(F.col(power)) < still) | (F.abs(F.col(current)) < still)
    return df.where((F.col(speed) > min_speed) & idle)


def level_jumps(df: DataFrame, level: str, future: str, min_rise: float = 2.0) -> DataFrame:
    """Rows whose level rises by more than `min_rise` until the label time."""
    return df.withColumn("level_change", F.col(future) - F.col(level)).where(F.col("level_change") > min_rise)


def quiet_rows(df: DataFrame, level: str, future: str, **columns: str) -> DataFrame:
    """Add the flag of a vehicle at rest and the change of level until the label time."""
    return df.withColumns({"is_physics_quiet": quiet_flag(**columns), "level_change": F.col(future) - F.col(level)})


def trip_bands(
    df: DataFrame, trip: Sequence[str], time: str, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """Extent of each trip, numbered by trip id, with alternating parity."""
    extents = df.groupBy(*trip).agg(F.min(time).alias("band_start"), F.max(time).alias("band_end"))
    ranked = positions(
        extents.withColumn("_all", F.lit(0)), Series("_all", "band_start", tuple(trip), max_rows), "band"
    )
    return ranked.drop("_all").withColumn("parity", (F.col("band") % 2).cast("int"))
