"""Summaries of days that merge, exact distance probabilities, and distinct counts from bitmaps."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import drift, summaries


@pytest.fixture(scope="module")
def days(spark):
    df = spark.range(40_000).selectExpr("id", "concat('d', id % 8) AS dt", "id % 3 AS k")
    noise = (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003).cast("double")
    df = df.withColumns({"a": F.when(F.col("id") % 10 != 0, noise * noise * 100), "b": F.floor(noise * 7), "none": F.lit(None).cast("double")})
    return df.withColumn("a", F.when(F.col("id") % 999 == 0, F.lit(float("nan"))).otherwise(F.col("a")))


def test_merged_days_equal_the_rows(spark, days):
    made = summaries.daily_summaries(days, ["a", "b", "none", "absent"])
    assert made.count() == 24
    some = ["d1", "d2", "d5", "d7"]
    merged = {r.feature: r for r in summaries.summary_baseline(summaries.merged_summaries(made.where(F.col("dt").isin(some)))).collect()}
    rows = days.where(F.col("dt").isin(some))
    exact = {r.feature: r for r in drift.baseline(rows, ["a", "b", "none"]).collect()}
    assert merged.keys() == exact.keys()
    for f, r in exact.items():
        assert (merged[f].n, merged[f].null_rate) == (r.n, pytest.approx(r.null_rate))
        assert merged[f]["mean"] == (pytest.approx(r["mean"]) if r["mean"] is not None else None)
        assert merged[f]["std"] == (pytest.approx(r["std"]) if r["std"] is not None else None)
    values = np.sort([r[0] for r in rows.select("a").dropna().collect()])
    for name, q in drift.BASELINE_QUANTILES.items():
        assert abs(np.searchsorted(values, merged["a"][name]) / len(values) - q) <= 2 * summaries.RANK_ERROR
    assert merged["none"]["p50"] is None


def test_merging_in_two_steps_and_by_group(spark, days):
    made = summaries.daily_summaries(days, ["a"], by=["k"])
    merged = summaries.merged_summaries(made, ["k"])
    want = {r.k: (r.n, r.m) for r in days.where(~F.isnan("a")).groupBy("k").agg(F.count("a").alias("n"), F.avg("a").alias("m")).collect()}
    assert {r.k: (r.n, pytest.approx(r["mean"])) for r in merged.collect()} == want
    halves = [summaries.merged_summaries(made.where(c), ["k"]) for c in ("dt < 'd4'", "dt >= 'd4'")]
    again = summaries.merged_summaries(halves[0].unionByName(halves[1]), ["k"])
    assert {r.k: (r.n, pytest.approx(r["mean"]), pytest.approx(r.spread)) for r in again.collect()} == {r.k: (r.n, r["mean"], r.spread) for r in merged.collect()}


def test_drift_from_summaries(spark, days):
    moved = days.withColumn("a", F.col("a") * 1.5 + 5)
    old, new, same = (summaries.merged_summaries(summaries.daily_summaries(d, ["a", "b", "none"])) for d in (days.where("dt < 'd4'"), moved.where("dt >= 'd4'"), days.where("dt >= 'd4'")))
    rows = {r.feature: r for r in summaries.summary_drift(old, new).collect()}
    whole = {r.feature: r for r in drift.drift_report(drift.baseline(days.where("dt < 'd4'"), ["a", "b"]), moved.where("dt >= 'd4'"), days.where("dt < 'd4'")).collect()}
    assert rows["a"].status == whole["a"].status == "DRIFT" and rows["none"].status == "INSUFFICIENT_DATA"
    for f in ("a", "b"):
        assert abs(rows[f].ks_stat - whole[f].ks_stat) <= 4 * summaries.RANK_ERROR
        assert rows[f].psi == pytest.approx(whole[f].psi, abs=0.05 * max(1, whole[f].psi))
        assert rows[f].mean_shift_pct == whole[f].mean_shift_pct and rows[f].null_rate_change == whole[f].null_rate_change
    assert {r.feature: r.status for r in summaries.summary_drift(old, same).collect()} == {"a": "STABLE", "b": "STABLE", "none": "INSUFFICIENT_DATA"}


def test_merged_days_read_no_rows(spark, days, folder):
    summaries.daily_summaries(days, ["a"]).write.parquet(f"{folder}/s")
    kept = spark.read.parquet(f"{folder}/s")
    plan = summaries.summary_drift(summaries.merged_summaries(kept.where("dt = 'd1'")), summaries.merged_summaries(kept.where("dt = 'd2'")))
    assert "Range" not in plan._jdf.queryExecution().executedPlan().toString().replace("RangePartitioning", "")


@pytest.mark.parametrize("n, m", [(1, 1), (2, 3), (4, 4), (3, 5), (6, 2), (5, 5)])
def test_exact_probability_equals_enumeration(n, m):
    counts = {}
    for ours in itertools.combinations(range(n + m), n):
        x = y = most = 0
        for i in range(n + m):
            x, y = (x + 1, y) if i in ours else (x, y + 1)
            most = max(most, abs(x * m - y * n))
        counts[most] = counts.get(most, 0) + 1
    total = sum(counts.values())
    for h in counts:
        assert drift.ks_exact(h / (n * m), n, m) == pytest.approx(sum(c for k, c in counts.items() if k >= h) / total)
    assert drift.ks_exact(0.0, n, m) == 1.0 and np.isnan(drift.ks_exact(0.5, 0, m))


def test_the_chosen_branch_is_a_column(spark):
    rng = random.Random(1)
    rows = [("small", rng.random(), s) for s in (0, 1) for _ in range(50 + s)] + [("large", rng.random(), s) for s in (0, 1) for _ in range(300)]
    rows += [("one side", 1.0, 0), ("small", None, 1)]
    df = spark.createDataFrame(rows, "feature string, value double, s int")
    pairs = drift.paired_counts(df.where("s = 0"), df.where("s = 1"))
    got = {r.feature: r for r in drift.ks(pairs, drift.measure(pairs, drift.Series(drift.FEATURE, "value")), exact_upto=100).collect()}
    assert got["small"].ks_method == "exact" and got["small"].ks_pvalue == pytest.approx(drift.ks_exact(got["small"].ks_stat, 50, 51))
    assert got["large"].ks_method == "limit" and got["one side"].ks_stat is None and got["one side"].ks_pvalue is None
    assert drift.ks_exact(0.02, 10_000, 9_999) == pytest.approx(drift.kolmogorov(0.02 * (10_000 * 9_999 / 19_999) ** 0.5), abs=2e-3)


def test_distinct_counts_from_bitmaps(spark):
    rng = random.Random(5)
    rows = [(f"d{rng.randrange(6)}", rng.choice("xy"), rng.choice([None, *range(300)]), str(rng.randrange(40))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "dt string, k string, v int, w string").repartition(7)
    first = summaries.dictionary(df.where("dt < 'd3'"), ["v", "w", "dt"]).cache()
    ids = summaries.dictionary(df, ["v", "w", "dt"], first).cache()
    assert ids.count() == ids.select("column", "value").distinct().count() == ids.select("column", "id").distinct().count()
    assert first.exceptAll(ids).count() == 0
    bitmaps = summaries.distinct_bitmaps(df, ["v", "w", "dt"], ids, by=["k"])
    days = ["d1", "d2", "d5"]
    got = {(r.k, r["column"]): r["values"] for r in summaries.distinct_counts(bitmaps.where(F.col("dt").isin(days)), ["k"]).collect()}
    want = {(k, c): len({r[i] for r in rows if r[1] == k and r[0] in days and r[i] is not None}) for k in "xy" for c, i in (("v", 2), ("w", 3), ("dt", 0))}
    assert got == want
    assert summaries.distinct_counts(bitmaps.limit(0)).collect() == []
