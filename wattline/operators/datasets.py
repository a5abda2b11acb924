"""Training sets and leak-free splits. A trip is never cut: the trip decides the side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.scalar import charging_flags, existing, require, without_bits
from wattline.operators.series import MAX_ROWS, Series, positions

META = ("dt", "vehicle_id", "timestamp", "trip_id", "label_available", "quality_flag", "battery_current_a", "motor_speed_rpm", "soc_pct")
DERIVED = ("is_charging_current", "is_parked_charging")


def training_rows(
    gold: DataFrame,
    features: Sequence[str],
    target: str,
    drop_mask: int,
    label: str = "label_available",
    label_value: int = 1,
    drop_nulls: bool = True,
) -> DataFrame:
    """Labelled rows of good quality with every feature; only the columns needed are read."""
    df = existing(gold, [*META, *features, target])
    if label in df.columns:
        df = df.where(F.col(label) == label_value)
    if "quality_flag" in df.columns:
        df = without_bits(df, "quality_flag", drop_mask)
    if set(DERIVED) & set(features):
        require(df, ["battery_current_a", "motor_speed_rpm"], "feature rows")
        df = df.withColumns(charging_flags())
    require(df, [*features, target], "feature rows")
    return df.dropna(subset=[*features, target]) if drop_nulls else df


def trip_starts(df: DataFrame, trip: Sequence[str] = ("trip_id",), time: str = "timestamp") -> DataFrame:
    return df.groupBy(*trip).agg(F.min(time).alias("start"))


def split_by_dates(
    df: DataFrame,
    train_dates: Sequence[str],
    val_dates: Sequence[str],
    trip: Sequence[str] = ("trip_id",),
    time: str = "timestamp",
) -> DataFrame:
    """Add `split` by the date each trip began; trips of other dates are left out."""
    day = F.date_format(F.to_date("start"), "yyyy-MM-dd")
    sides = trip_starts(df, trip, time).select(
        *trip, F.when(day.isin(*train_dates), "train").when(day.isin(*val_dates), "val").alias("split")
    )
    return df.join(sides.where(F.col("split").isNotNull()), list(trip), "inner")


def split_last_trips(
    df: DataFrame,
    n_val: int,
    trip: Sequence[str] = ("trip_id",),
    time: str = "timestamp",
) -> DataFrame:
    """Add `split`: the `n_val` trips that began last are "val". Fails if there are no others."""
    newest = trip_starts(df, trip, time).orderBy(F.col("start").desc(), *[F.col(k).desc() for k in trip])
    few = newest.limit(n_val + 1)  # one more, to see that something is left to train on
    enough = few.agg((F.count(F.lit(1)) > n_val).alias("ok")).select("ok").scalar()
    message = F.lit(f"not enough trips for {n_val} validation trips")
    val = newest.limit(n_val).select(*trip, F.lit(True).alias("_val"))
    marked = df.join(F.broadcast(val), list(trip), "left")  # at most n_val rows
    side = F.when(F.col("_val"), "val").otherwise("train")
    return marked.withColumn("split", F.when(enough, side).otherwise(F.raise_error(message))).drop("_val")


def _split_ranked(df, trips, order: str, trip, test_frac, last: bool, max_rows) -> DataFrame:
    """Rank all trips by `order` and cut off a share of them at one end."""
    trips = trips.withColumn("_all", F.lit(0))
    ranked = positions(trips, Series("_all", order, tuple(trip), max_rows), "_rank")
    total = trips.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    n_test = F.greatest(F.lit(1), F.bround(total * F.lit(test_frac)).cast("long"))
    is_test = F.col("_rank") >= total - n_test if last else F.col("_rank") < n_test
    sides = ranked.select(*trip, F.when(is_test, "test").otherwise("train").alias("split"))
    return df.join(sides, list(trip), "inner")


def split_shuffled(
    df: DataFrame, test_frac: float, seed: int, trip: Sequence[str] = ("trip_id",), max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """Add `split`: a seeded random share of the trips is "test"; the same trips on every run."""
    trips = df.select(*trip).distinct().withColumn("_hash", trip_hash(trip, seed))
    return _split_ranked(df, trips, "_hash", trip, test_frac, False, max_rows)


def trip_hash(trip: Sequence[str], seed: int) -> Column:
    digest = F.md5(F.concat_ws("|", *[F.col(t).cast("string") for t in trip], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def split_by_share(
    df: DataFrame,
    test_frac: float,
    trip: Sequence[str] = ("trip_id",),
    time: str = "timestamp",
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Add `split`: the latest share of the trips is "test"."""
    return _split_ranked(df, trip_starts(df, trip, time), "start", trip, test_frac, True, max_rows)


def split_summary(split: DataFrame, trip: Sequence[str] = ("trip_id",), time: str = "timestamp") -> DataFrame:
    """Rows, trips, first and last trip start per side."""
    per_trip = split.groupBy("split", *trip).agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_s"))
    return per_trip.groupBy("split").agg(
        F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("trips"),
        F.min("_s").alias("first_start"),
        F.max("_s").alias("last_start"),
    )
