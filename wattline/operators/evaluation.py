"""Forecast evaluation: metrics, breakdowns, distributions and worst rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.config import Thresholds
from wattline.functions.scalar import clip, col
from wattline.operators.quantiles import exact_quantiles

# Lower and upper edges of the level buckets.
BUCKETS = ((0, 20), (20, 40), (40, 60), (60, 80), (80, 100))
# Quantiles of the error distribution and thresholds of the error tail.
ERROR_QUANTILES = {"p5": 0.05, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95}
TAIL = (0.5, 1.0, 2.0, 3.0, 4.0)


def scored(df: DataFrame, y: str, pred: str = "pred", lo: float | None = 0, hi: float | None = 100) -> DataFrame:
    """Clip the prediction and add `error` and `abs_error`."""
    value = col(pred) if lo is None or hi is None else clip(col(pred), lo, hi)
    return (
        df.withColumn(pred, value)
        .withColumn("error", F.col(pred) - F.col(y))
        .withColumn("abs_error", F.abs("error"))
    )


def mae(y: str, pred: str) -> Column:
    return F.avg(F.abs(F.col(pred) - F.col(y)))


def rmse(y: str, pred: str) -> Column:
    gap = F.col(pred) - F.col(y)
    return F.sqrt(F.avg(gap * gap))


def mape(y: str, pred: str) -> Column:
    """Percentage error with the denominator kept at 1 or more."""
    size = F.greatest(F.abs(F.col(y)), F.lit(1.0))
    return F.avg(F.abs(F.col(pred) - F.col(y)) / size) * 100


def metric_columns(y: str, pred: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        mae(y, pred).alias("mae"),
        rmse(y, pred).alias("rmse"),
        mape(y, pred).alias("mape"),
    ]


def finite(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows where all the named columns are finite numbers."""
    for n in names:
        df = df.where(F.col(n).isNotNull() & ~F.isnan(n) & (F.abs(F.col(n)) < float("inf")))
    return df


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = (), only_finite: bool = False) -> DataFrame:
    """Rows, MAE, RMSE and MAPE; with `by`, one row per group, worst first."""
    if only_finite:
        df = finite(df, [y, pred])
    out = df.groupBy(*by).agg(*metric_columns(y, pred))
    return out.orderBy(F.col("mae").desc(), *by) if by else out


def bucket_metrics(df: DataFrame, y: str, pred: str, level: str) -> DataFrame:
    """Metrics per `[lo, hi)` bucket of the current level; empty buckets and the top edge are left out."""
    lo, hi = BUCKETS[0][0], BUCKETS[-1][1]
    width = BUCKETS[0][1] - lo
    inside = df.where((F.col(level) >= lo) & (F.col(level) < hi))
    low = (F.floor((F.col(level) - lo) / width) * width + lo).cast("int")
    label = F.concat(low.cast("string"), F.lit("–"), (low + width).cast("string"), F.lit("%"))
    return inside.withColumn("soc_bucket", label).groupBy("soc_bucket").agg(*metric_columns(y, pred))


def actual_bucket_mae(df: DataFrame, y: str, pred: str) -> DataFrame:
    """MAE per `(lo, hi]` bucket of the actual value."""
    lo, hi = BUCKETS[0][0], BUCKETS[-1][1]
    width = BUCKETS[0][1] - lo
    inside = df.where((F.col(y) > lo) & (F.col(y) <= hi))
    top = (F.ceil((F.col(y) - lo) / width) * width + lo).cast("int")
    label = F.concat(F.lit("("), (top - width).cast("string"), F.lit(", "), top.cast("string"), F.lit("]"))
    return inside.withColumn("bucket", label).groupBy("bucket").agg(mae(y, pred).alias("mae"))


def error_distribution(df: DataFrame, error: str = "error", by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, exact quantiles and largest absolute error."""
    stats = [
        F.avg(error).alias("mean"),
        F.stddev_samp(error).alias("std"),
        F.max(F.abs(F.col(error))).alias("max_abs"),
    ]
    cuts = exact_quantiles(df, error, ERROR_QUANTILES, by)
    if by:
        return df.groupBy(*by).agg(*stats).join(cuts, list(by), "left")
    one = cuts.select(F.struct(*ERROR_QUANTILES).alias("q")).scalar()
    return df.agg(*stats).withColumn("_q", one).select("mean", "std", "_q.*", "max_abs")


def baseline_maes(df: DataFrame, y: str, now: str, rolled: str | None = None) -> DataFrame:
    """MAE of predicting the current level and, if given, its rolling mean."""
    out = [mae(y, now).alias("persistence_mae")]
    if rolled:
        out.append(mae(y, rolled).alias("rolling_mae"))
    return df.agg(*out)


def slice_metrics(df: DataFrame, y: str, pred: str, now: str) -> DataFrame:
    """MAE, RMSE and count where the level will rise, fall or stay; all three rows always appear."""
    good = finite(df, [y, pred, now])
    gap, move = F.col(pred) - F.col(y), F.col(y) - F.col(now)
    slices = {"charging": move > 0, "discharging": move < 0, "flat": move == 0}
    cells = [
        F.struct(
            F.lit(name).alias("slice"),
            F.avg(F.when(test, F.abs(gap))).alias("mae"),
            F.sqrt(F.avg(F.when(test, gap * gap))).alias("rmse"),
            F.count_if(test).alias("n"),
        ).alias(name)
        for name, test in slices.items()
    ]
    return good.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def worst_rows(df: DataFrame, k: int, score: str = "abs_error", ties: Sequence[str] = ()) -> DataFrame:
    """The `k` rows with the largest score; ties in the order of `ties`."""
    return df.orderBy(F.col(score).desc_nulls_last(), *ties).limit(k)


def worst_row(df: DataFrame, score: str = "abs_error", ties: Sequence[str] = ()) -> DataFrame:
    """The single worst row, found by combining, without a sort; ties in the order of `ties`, of any type."""
    best = F.min_by(F.struct(*df.columns), F.struct(-F.col(score), *ties))
    return df.where(F.col(score).isNotNull()).agg(best.alias("w")).select("w.*")


def status_label(val_mae: Column, gap: Column, t: Thresholds = Thresholds()) -> Column:
    return (
        F.when((val_mae < t.mae_excellent) & (gap < t.gap_ok), "EXCELLENT")
        .when(val_mae < t.mae_acceptable, "ACCEPTABLE")
        .when(val_mae < t.mae_investigate, "INVESTIGATE")
        .otherwise("FAILING")
    )


def train_val_metrics(df: DataFrame, y: str, pred: str, split: str = "split", t: Thresholds = Thresholds()) -> DataFrame:
    """Metrics of both sides in one pass, their gap and the status, as one row."""
    gap, size = F.col(pred) - F.col(y), F.greatest(F.abs(F.col(y)), F.lit(1.0))
    out = []
    for side in ("train", "val"):
        here = F.col(split) == side
        out += [
            F.count_if(here).alias(f"{side}_rows"),
            F.avg(F.when(here, F.abs(gap))).alias(f"{side}_mae"),
            F.sqrt(F.avg(F.when(here, gap * gap))).alias(f"{side}_rmse"),
            (F.avg(F.when(here, F.abs(gap) / size)) * 100).alias(f"{side}_mape"),
        ]
    both = df.agg(*out).withColumn("train_val_gap", F.round(F.col("val_mae") - F.col("train_mae"), 3))
    return both.withColumn("status", status_label(F.col("val_mae"), F.col("train_val_gap"), t))


def bias_and_drop(df: DataFrame, trip: Sequence[str], y: str, error: str, time: str, ties: Sequence[str] = ()) -> DataFrame:
    """Per trip: mean error, MAE and first minus last level."""
    first, last = F.min(F.struct(time, *ties, y)), F.max(F.struct(time, *ties, y))
    return df.groupBy(*trip).agg(
        F.avg(error).alias("bias"),
        F.avg(F.abs(F.col(error))).alias("mae"),
        (first.getField(y) - last.getField(y)).alias("level_drop"),
    )


def tail_shares(df: DataFrame, error: str = "abs_error", thresholds: Sequence[float] = TAIL) -> DataFrame:
    """Percentage of rows at or above each threshold; a NULL error counts as below."""
    at_least = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            (F.avg(F.when(F.col(error) >= t, 1.0).otherwise(0.0)) * 100).alias("pct"),
        )
        for t in thresholds
    ]
    return df.agg(F.array(*at_least).alias("a")).select(F.inline("a"))


def trip_summary(df: DataFrame, trip: str, level: str, error: str = "abs_error") -> DataFrame:
    """Per trip: rows, MAE, exact 95th percentile, worst error and the span of the level as text."""
    stats = df.groupBy(trip).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(error).alias("mae"),
        F.max(error).alias("max_abs"),
        F.min(level).alias("soc_min"),
        F.max(level).alias("soc_max"),
    )
    span = F.concat(
        F.round("soc_min", 1).cast("string"), F.lit("–"), F.round("soc_max", 1).cast("string"), F.lit("%")
    )
    cuts = exact_quantiles(df, error, {"p95": 0.95}, [trip])
    return stats.join(cuts, trip, "left").withColumn("soc_range", span)


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in `bins` equal-width bins over the range of each group; the last bin is closed."""
    keys = list(by)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    lo, hi = F.min("_v"), F.max("_v")
    pad = F.when(lo == hi, 0.5).otherwise(0.0)
    ends = rows.groupBy(*keys).agg((lo - pad).alias("_lo"), (hi + pad).alias("_hi")).where(F.col("_lo").isNotNull())
    if keys:
        placed = rows.join(ends, keys, "inner")
    else:
        range_ = ends.select(F.struct("_lo", "_hi").alias("r")).scalar()  # one row
        placed = rows.withColumn("_r", range_).select("_v", "_r.*")
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    placed = placed.withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
    counts = placed.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).alias("rows"),
    )


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """`n` rows chosen by a seeded hash of their key: the same rows on every run."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(digest, *keys).limit(n)
