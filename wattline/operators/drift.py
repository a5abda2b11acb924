"""Feature drift of new data against a reference: baselines, PSI, KS, mean shift and status."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from wattline.config import Thresholds
from wattline.operators.aggregates import unpivoted
from wattline.operators.quantiles import cumulative, quantiles_of_counts
from wattline.operators.series import MAX_ROWS, Series, measure
from wattline.session import stored

# Quantiles a baseline keeps, points of a sketch, bins of the stability index.
BASELINE_QUANTILES = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}
SKETCH_POINTS = 1000
PSI_BINS = 10
EPS = 1e-6
MIN_VALUES = 10
#: Values of the larger sample up to which the p-value is exact.
EXACT_UPTO = 10_000


FEATURE = ("feature",)


def feature_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    have = [f for f in features if f in df.columns]
    return unpivoted(df, have).withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def counted_values(long: DataFrame, name: str = "n") -> DataFrame:
    """(feature, value, n) for every distinct value, NULL included: what all figures of a feature follow from."""
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias(name))


def _moments(counts: DataFrame, n: str = "n") -> DataFrame:
    """Mean, deviation, NULL rate and number of values per feature, from counts per distinct value."""
    have = F.when(F.col("value").isNotNull(), F.col(n)).otherwise(0)
    sums = counts.groupBy("feature").agg(F.sum(F.col("value") * F.col(n)).alias("_s"), F.sum(have).alias("_n"), F.sum(n).alias("_all"))
    sums = sums.select("feature", (F.col("_s") / F.nullif(F.col("_n"), F.lit(0))).alias("mean"), "_n", "_all")
    gap = F.col("value") - F.col("mean")
    around = counts.join(F.broadcast(sums), "feature").groupBy("feature", "mean", "_n", "_all").agg(F.sum(gap * gap * F.col(n)).alias("_m"))
    return around.select(
        "feature",
        "mean",
        F.sqrt(F.col("_m") / F.nullif(F.col("_n") - 1, F.lit(0))).alias("std"),
        ((F.col("_all") - F.col("_n")) / F.nullif(F.col("_all"), F.lit(0))).alias("null_rate"),
        F.col("_n").cast("long").alias("n"),
    )


def baseline(df: DataFrame, features: Sequence[str], max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Distribution of each feature; one that is always NULL keeps its row. The rows are read once, to count values."""
    counts = stored(counted_values(feature_values(df, features)), "values")
    present = counts.where(F.col("value").isNotNull())
    series = measure(present, Series(FEATURE, "value", max_rows=max_rows))
    cuts = quantiles_of_counts(present, series, BASELINE_QUANTILES)
    return _moments(counts).join(cuts, "feature", "left").select(
        "feature", "mean", "std", *BASELINE_QUANTILES, "null_rate", "n"
    )


def sketch_values(base: DataFrame, points: int = SKETCH_POINTS) -> DataFrame:
    """Evenly spaced points through the five kept quantiles, flat beyond the outer two."""
    at = list(BASELINE_QUANTILES.values())
    names = list(BASELINE_QUANTILES)
    x = F.col("_i") / (points - 1)
    value = F.when(x <= at[0], F.col(names[0]))
    for i in range(1, len(at)):
        slope = (F.col(names[i]) - F.col(names[i - 1])) / (at[i] - at[i - 1])
        value = value.when(x <= at[i], F.col(names[i - 1]) + slope * (x - at[i - 1]))
    value = value.otherwise(F.col(names[-1]))
    spread = base.where(F.col("n") > 0).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return spread.select("feature", value.alias("value"))


def edges(pairs: DataFrame, series: Series, bins: int = PSI_BINS) -> DataFrame:
    """Distinct quantiles of the reference values of `paired_counts`, ascending, as one short array per feature."""
    names = {f"_e{i}": i / bins for i in range(bins + 1)}
    counts = pairs.where(F.col("n_ref") > 0).select("feature", "value", F.col("n_ref").alias("n"))
    cuts = quantiles_of_counts(counts, series, names)
    return cuts.select("feature", F.array_sort(F.array_distinct(F.array(*names))).alias("edges"))


def counted_pairs(ref: DataFrame, new: DataFrame) -> DataFrame:
    """(feature, value, n_ref, n_new) for every distinct value on either side, NULL included: one shuffle for both."""
    sides = [d.select("feature", "value", F.lit(s).alias("_new")) for d, s in ((ref, 0), (new, 1))]
    return sides[0].unionByName(sides[1]).groupBy("feature", "value").agg(
        F.sum(1 - F.col("_new")).alias("n_ref"), F.sum("_new").cast("long").alias("n_new")
    )


def paired_counts(ref: DataFrame, new: DataFrame) -> DataFrame:
    """`counted_pairs` of the values that are not NULL."""
    return counted_pairs(ref, new).where(F.col("value").isNotNull() & ~F.isnan("value"))


def psi(pairs: DataFrame, cuts: DataFrame, open_ends: bool) -> DataFrame:
    """Population stability index per feature from counts per distinct value.

    Closed ends: values outside the edges fall in no bin but still count in the denominator.
    Open ends: the outer bins take them.
    """
    placed = pairs.join(F.broadcast(cuts), "feature", "inner")  # one row per feature column
    last = F.size("edges") - 1
    below = F.size(F.filter("edges", lambda e: e <= F.col("value")))
    at_top = F.col("value") == F.element_at("edges", -1)
    slot = F.when(at_top, last).otherwise(below)
    if open_ends:
        slot = F.least(F.greatest(slot, F.lit(1)), last)
        usable = F.lit(True)
    else:
        usable = (slot >= 1) & (slot <= last)
    binned = placed.select(
        "feature", F.when(usable, slot).alias("_bin"), "n_ref", "n_new", (F.size("edges") < 2).alias("_flat")
    )
    bins = binned.groupBy("feature", "_bin").agg(
        F.sum("n_ref").alias("r"), F.sum("n_new").alias("a"), F.max("_flat").alias("_flat")
    )
    totals = bins.groupBy("feature").agg(F.sum("r").alias("_r"), F.sum("a").alias("_a"))
    bins = bins.join(F.broadcast(totals), "feature", "inner")
    share = {}
    for side in ("r", "a"):
        s = F.col(side) / (F.col(f"_{side}") + EPS)
        share[side] = F.when(s == 0, F.lit(EPS)).otherwise(s)
    term = (share["a"] - share["r"]) * F.ln(share["a"] / share["r"])
    counted = F.when(F.col("_bin").isNotNull() & ~F.col("_flat"), term).otherwise(0.0)
    return bins.groupBy("feature").agg(F.round(F.sum(counted), 4).alias("psi"))


def ks(pairs: DataFrame, series: Series, exact_upto: int = EXACT_UPTO) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and its p-value per feature: exact if neither sample has more than
    `exact_upto` values, else by the limiting series; `ks_method` says which."""
    ranked = cumulative(pairs, series, ["n_ref", "n_new"])
    gap = F.abs(
        F.col("_upto_n_ref") / F.col("_total_n_ref") - F.col("_upto_n_new") / F.col("_total_n_new")
    )
    both = (F.col("_total_n_ref") > 0) & (F.col("_total_n_new") > 0)
    out = ranked.groupBy("feature").agg(
        F.max(F.when(both, gap)).alias("ks_stat"),
        F.max("_total_n_ref").alias("_r"),
        F.max("_total_n_new").alias("_a"),
    )
    small = F.col("ks_stat").isNotNull() & (F.greatest("_r", "_a") <= exact_upto)
    limit = ks_pvalue(F.col("ks_stat"), F.col("_r"), F.col("_a"))
    if exact_upto <= 0:
        return out.select("feature", "ks_stat", limit.alias("ks_pvalue"), F.lit("limit").alias("ks_method"))
    # one row per feature: the recursion runs only on those that are small
    sizes = [F.when(small, F.col(c)).otherwise(0) for c in ("_r", "_a")]
    exact = _exact(F.coalesce("ks_stat", F.lit(0.0)), *sizes)
    return out.select(
        "feature", "ks_stat", F.when(small, exact).otherwise(limit).alias("ks_pvalue"), F.when(small, "exact").otherwise("limit").alias("ks_method")
    )


def ks_exact(d: float, n: int, m: int) -> float:
    """P(distance >= d) of two samples of n and m distinct values of one distribution.

    A random order of the values is a path from (0, 0) to (n, m). w[i] is the chance that a path has kept |x/n - y/m|
    below d up to the point (i, k - i); the path came there from the left with chance i/k.
    """
    if n <= 0 or m <= 0:
        return float("nan")
    h = round(d * n * m)
    if h <= 0:
        return 1.0
    w, i = np.zeros(n + 1), np.arange(n + 1)
    w[0] = 1.0
    for k in range(1, n + m + 1):
        here = w * (k - i) / k
        here[1:] += w[:-1] * i[1:] / k
        here[(i > k) | (k - i > m) | (np.abs(i * m - (k - i) * n) >= h)] = 0.0
        w = here
    return float(min(max(1.0 - w[n], 0.0), 1.0))


@F.pandas_udf(DoubleType())
def _exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_exact(*row) for row in zip(d, n.astype(int), m.astype(int))])


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Kolmogorov's limit series; for a tiny statistic, where it converges slowly, the limit is 1."""
    x = F.sqrt(n * m / (n + m)) * d
    steps = F.sequence(F.lit(1), F.lit(terms))
    total = F.aggregate(
        F.transform(steps, lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(k * k * x * x * -2.0)),
        F.lit(0.0),
        lambda acc, t: acc + t,
    )
    return F.when(x < 0.2, F.lit(1.0)).when(x.isNotNull(), F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def drift_report(
    base: DataFrame,
    new: DataFrame,
    reference: DataFrame | None = None,
    thresholds: Thresholds = Thresholds(),
    max_rows: int | None = MAX_ROWS,
    exact_upto: int = EXACT_UPTO,
) -> DataFrame:
    """One row per baseline feature that the new data has.

    With `reference`, the sample behind the baseline, bins and distances come from its values. Without
    it they come from a sketch through the five kept quantiles, which reports drift too readily.
    """
    base = stored(base, "baseline")  # a row per feature column; what it comes from is not computed again
    features = [r[0] for r in base.select("feature").collect()]  # column names
    features = [f for f in features if f in new.columns]
    base = base.where(F.col("feature").isin(*features))
    fresh = feature_values(new, features)
    sample = reference is not None
    ref = feature_values(reference, features) if sample else sketch_values(base)
    counts = stored(counted_pairs(ref, fresh), "pairs")  # the only reading of the rows
    pairs = counts.where(F.col("value").isNotNull())
    series = measure(pairs, Series(FEATURE, "value", max_rows=max_rows))
    cuts = edges(pairs, series)
    now = _moments(counts, "n_new").select(
        "feature", F.col("mean").alias("_mean"), F.col("null_rate").alias("_null"), F.col("n").alias("_n")
    )
    joined = (
        base.join(now, "feature", "inner")
        .join(psi(pairs, cuts, sample), "feature", "left")
        .join(ks(pairs, series, exact_upto), "feature", "left")
    )
    return drift_status(joined, thresholds)


def drift_status(joined: DataFrame, t: Thresholds) -> DataFrame:
    shift = F.abs(F.col("_mean") - F.col("mean")) / (F.abs(F.col("mean")) + EPS) * 100
    few = F.col("_n") < MIN_VALUES
    status = (
        F.when(few, "INSUFFICIENT_DATA")
        .when((F.col("psi") >= t.psi_alert) | (F.col("ks_pvalue") < t.ks_pvalue) | (shift > t.mean_shift_pct), "DRIFT")
        .when(F.col("psi") >= t.psi_monitor, "MONITOR")
        .otherwise("STABLE")
    )

    def shown(c: Column, digits: int) -> Column:
        return F.when(~few, F.round(c, digits))

    return joined.select(
        "feature",
        status.alias("status"),
        shown(F.col("psi"), 4).alias("psi"),
        shown(F.col("ks_stat"), 4).alias("ks_stat"),
        shown(F.col("ks_pvalue"), 4).alias("ks_pvalue"),
        shown(F.col("mean"), 4).alias("mean_ref"),
        shown(F.col("_mean"), 4).alias("mean_new"),
        shown(shift, 2).alias("mean_shift_pct"),
        shown(F.col("null_rate"), 4).alias("null_rate_ref"),
        shown(F.col("_null"), 4).alias("null_rate_new"),
        shown(F.col("_null") - F.col("null_rate"), 4).alias("null_rate_change"),
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """Features checked, how many drift, are to be watched or are stable, and the worst status."""
    counts = report.agg(
        F.count(F.lit(1)).alias("features_checked"),
        *[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in ("DRIFT", "MONITOR", "STABLE")],
    )
    overall = F.when(F.col("n_drift") > 0, "DRIFT").when(F.col("n_monitor") > 0, "MONITOR").otherwise("STABLE")
    return counts.withColumn("overall_status", overall)


def kolmogorov(x: float, terms: int = 100) -> float:
    """The same series for a single number, for checks."""
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, sum((2 if k % 2 else -2) * math.exp(-2 * k * k * x * x) for k in range(1, terms + 1))))
