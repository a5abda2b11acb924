"""Per-day summaries that merge: distributions as quantile sketches, exact distinct counts as bitmaps.

A day is summarised once. What is asked of any range of days is merged from its days' rows; the readings themselves are
not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.config import Thresholds
from wattline.operators.aggregates import unpivoted
from wattline.operators.drift import BASELINE_QUANTILES, EPS, PSI_BINS, drift_status, ks_pvalue

#: Size of a sketch. Ranks are off by less than RANK_ERROR of the rows with 99 % confidence, however many days are merged.
SKETCH_SIZE = 800
RANK_ERROR = 0.005
#: Values that a sketch is read at for its ranks: they add half a part in so many to the error.
POINTS = 400


def daily_summaries(df: DataFrame, features: Sequence[str], day: str = "dt", by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """by, day, feature, rows, n, mean, spread (sum of squared distances from the mean), sketch: a row for each day and
    feature, one aggregation. NULL and NaN count as rows without a value; a feature without values has no sketch."""
    long = unpivoted(df, [f for f in features if f in df.columns], [*by, day])
    value = F.when(~F.isnan("value"), F.col("value"))
    return long.withColumn("value", value).groupBy(*by, day, "feature").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("spread"),
        F.kll_sketch_agg_double("value", size).alias("sketch"),
    ).withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def merged_summaries(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per feature (and `by`) from the rows of several days."""
    keys = [*by, "feature"]
    weighed = days.where(F.col("n") > 0).groupBy(*keys).agg((F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("_mean"))
    joined = days.join(weighed, keys, "left")
    apart = F.col("mean") - F.col("_mean")
    return joined.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("spread") + apart * apart * F.col("n")).alias("spread"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    ).withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def summary_baseline(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns of `drift.baseline`; quantiles are values of the data whose rank is off by RANK_ERROR at most."""
    quantiles = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(q) for q in BASELINE_QUANTILES.values()]))
    return merged.withColumn("_q", F.when(F.col("sketch").isNotNull(), quantiles)).select(
        *by, "feature", "mean", F.sqrt(F.col("spread") / F.nullif(F.col("n") - 1, F.lit(0))).alias("std"),
        *[F.col("_q")[i].alias(name) for i, name in enumerate(BASELINE_QUANTILES)],
        (1 - F.col("n") / F.col("rows")).alias("null_rate"), "n",
    )


def _shares(ranks: Column, n: Column) -> Column:
    """Shares of the bins between ranks at ascending edges, the outer bins open; empty ones count as EPS."""
    inner = F.slice(ranks, 2, F.greatest(F.size(ranks) - 2, F.lit(0)))
    ends = F.concat(inner, F.array(F.lit(1.0)))
    starts = F.concat(F.array(F.lit(0.0)), inner)
    share = F.zip_with(ends, starts, lambda e, s: (e - s) * n / (n + EPS))
    return F.transform(share, lambda s: F.when(s <= 0, F.lit(EPS)).otherwise(s))


def summary_drift(ref: DataFrame, new: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The drift report of two merged ranges of days, from their summaries alone.

    Shares of the reference's tenths and the KS distance follow from ranks in the sketches; each is off by 2 RANK_ERROR at
    most. The p-value is the limiting series.
    """
    a = summary_baseline(ref).join(ref.select("feature", F.col("sketch").alias("_ref")), "feature")
    b = new.select("feature", F.col("sketch").alias("_new"), F.col("mean").alias("_mean"), F.col("n").alias("_n"), (1 - F.col("n") / F.col("rows")).alias("_null"))
    joined = a.join(b, "feature")
    both = F.col("_ref").isNotNull() & F.col("_new").isNotNull()
    tenths = F.array(*[F.lit(i / PSI_BINS) for i in range(PSI_BINS + 1)])
    points = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    read = {
        f"_{side}_{name}": F.when(both, F.kll_sketch_get_quantile_double(f"_{side}", ranks))
        for side, name, ranks in (("ref", "tenths", tenths), ("ref", "points", points), ("new", "points", points))
    }
    joined = joined.withColumns(read).withColumn("_edges", F.array_sort(F.array_distinct("_ref_tenths")))

    def rank(side: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.size(F.filter(f"_{side}_points", lambda q: q <= x)) / POINTS)

    joined = joined.withColumns({"_r": rank("ref", F.col("_edges")), "_a": rank("new", F.col("_edges"))})
    values = F.concat("_ref_points", "_new_points")
    gaps = F.zip_with(rank("ref", values), rank("new", values), lambda x, y: F.abs(x - y))
    joined = joined.withColumns({
        "_r": _shares(F.col("_r"), F.col("n")), "_a": _shares(F.col("_a"), F.col("_n")), "ks_stat": F.when(both, F.array_max(gaps)),
    })
    terms = F.zip_with("_a", "_r", lambda x, y: (x - y) * F.ln(x / y))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    flat = F.size("_edges") < 2
    out = joined.withColumns({
        "psi": F.round(F.when(flat, 0.0).otherwise(total), 4),
        "ks_pvalue": ks_pvalue(F.col("ks_stat"), F.nullif("n", F.lit(0)), F.nullif("_n", F.lit(0))),
    })
    return drift_status(out, thresholds)


# ---- exact distinct counts


def dictionary(df: DataFrame, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """column, value (as text), id: a number for each distinct value of each column, NULL aside. Values that are `known`
    keep theirs; new ones are numbered after them. Store the result: ids must not be given out twice."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    fresh = texts.where(F.col("value").isNotNull()).distinct()
    if known is None:
        return fresh.withColumn("id", F.monotonically_increasing_id())
    fresh = fresh.join(known, ["column", "value"], "left_anti")
    above = known.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("top"))
    numbered = fresh.withColumn("id", F.monotonically_increasing_id() + above.scalar() + 1)
    return known.select("column", "value", "id").unionByName(numbered)


def distinct_bitmaps(df: DataFrame, columns: Sequence[str], ids: DataFrame, day: str = "dt", by: Sequence[str] = ()) -> DataFrame:
    """by, day, column, bucket, bitmap: which ids of a bucket of 32,768 the day has."""
    keys = [*by, day]
    long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns if c not in keys], *[F.col(c).cast("string").alias(f"_{c}") for c in columns if c in keys])
    names = [c if c not in keys else f"_{c}" for c in columns]
    long = long.unpivot(keys, names, "column", "value").withColumn("column", F.regexp_replace("column", "^_", "") if set(columns) & set(keys) else F.col("column"))
    found = long.where(F.col("value").isNotNull()).join(ids, ["column", "value"])
    position = F.col("id") + 1  # the functions count from 1
    return found.groupBy(*keys, "column", F.bitmap_bucket_number(position).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bitmap")
    )


def distinct_counts(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, column, values: exact distinct counts over the days of the bitmaps. Bitmaps are OR-ed bucket by bucket."""
    merged = bitmaps.groupBy(*by, "column", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy(*by, "column").agg(F.sum("n").alias("values"))
