import random

import pytest
from pyspark.sql import functions as F

from wattline.config import ResampleConfig
from wattline.operators.resample import collapse_duplicates, resample

KEYS = ["dt", "vehicle_id"]


def frame(spark, points, signal="stack_voltage_v"):
    rows = [("d", "v", float(t), None if x is None else float(x)) for t, x in points]
    df = spark.createDataFrame(rows, f"dt string, vehicle_id string, t double, {signal} double")
    return df.withColumn("timestamp", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).drop("t")


def ticks(df, signal="stack_voltage_v"):
    return [(r["s"], r[signal], r["quality_flag"]) for r in df.withColumn("s", F.unix_seconds("timestamp")).orderBy("s").collect()]


@pytest.mark.parametrize("chunk", [21_600, 7])
def test_fast_fill_golden(spark, chunk):
    go = lambda p: ticks(resample(frame(spark, p), KEYS, chunk_ticks=chunk))
    assert go([(0, 10), (4, 18)]) == [(0, 10, 0), (1, 12, 5), (2, 14, 5), (3, 16, 5), (4, 18, 0)]
    assert [x for x in go([(0, 10), (10, 20)]) if x[1] is not None] == [(0, 10, 0), (5, 15, 5), (10, 20, 0)]
    assert [x[1] for x in go([(0, 10), (11, 21)])] == [10] + [None] * 10 + [21]
    # a missing reading on a real row is repaired without the inserted bit
    assert go([(0, 10), (1, None), (2, 12)])[1] == (1, 11, 1)


def test_slow_fill_golden(spark):
    out = ticks(resample(frame(spark, [(0, 1), (100, 2)], "soc_pct"), KEYS), "soc_pct")
    assert out[1:61] == [(t, 1, 6) for t in range(1, 61)]
    assert out[61:100] == [(t, None, 4) for t in range(61, 100)]


def test_duplicates_golden(spark):
    df = spark.createDataFrame(
        [("d", "v", 1, 50.0, 8, None, 1), ("d", "v", 2, 52.0, 16, "x", 0), ("d", "v", 3, None, 0, None, None)],
        "dt string, vehicle_id string, n int, soc_pct double, quality_flag int, status string, mcu int",
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(5)))
    r = collapse_duplicates(df, KEYS, "timestamp", order=["n"]).first()
    assert (r["soc_pct"], r["quality_flag"], r["status"], r["mcu"]) == (51.0, 24, "x", 0.5)


def test_fractional_times(spark):
    points = [(0, 1), (1.5, 9), (3, 3)]
    exact = ticks(resample(frame(spark, points), KEYS))
    assert [x[1] for x in exact] == [1, pytest.approx(5 / 3), pytest.approx(7 / 3), 3]
    floor = ticks(resample(frame(spark, points), KEYS, align="floor"))
    assert [(x[1], x[2]) for x in floor] == [(1, 0), (9, 0), (6, 5), (3, 0)]
    lone = ticks(resample(frame(spark, [(0, 1), (2.5, 9)]), KEYS))
    assert [x[0] for x in lone] == [0, 1, 2, 3]


def brute(points, fast, slow):
    """Fill tick by tick."""
    have = {t: x for t, x in points if x is not None}
    lo, hi = points[0][0], points[-1][0]
    out = []
    real = {t for t, _ in points}
    for t in range(lo, hi + 1):
        flag = 0 if t in real else 4
        value = held = have.get(t)
        if value is None:
            before = [u for u in have if u < t]
            after = [u for u in have if u > t]
            if before and after and t - max(before) <= fast and min(after) - t <= fast:
                a, b = max(before), min(after)
                value = have[a] + (have[b] - have[a]) / (b - a) * (t - a)
                flag |= 1
            if before and t - max(before) <= slow:
                held = have[max(before)]
                flag |= 2
        out.append((t, value, held, flag))
    return out


@pytest.mark.parametrize("chunk", [21_600, 40, 1])
def test_fills_equal_a_tick_by_tick_model(spark, chunk):
    rng = random.Random(chunk)
    points = [(t, round(rng.uniform(0, 9), 3) if rng.random() < 0.7 else None) for t in range(3, 900) if rng.random() < 0.35 and not 300 < t < 500]
    df = frame(spark, points).withColumn("soc_pct", F.col("stack_voltage_v"))
    out = resample(df, KEYS, config=ResampleConfig(1, 5, 20, 30), chunk_ticks=chunk)
    got = [
        (r["s"], r["stack_voltage_v"], r["soc_pct"], r["quality_flag"])
        for r in out.withColumn("s", F.unix_seconds("timestamp")).orderBy("s").collect()
    ]
    want = brute(points, 5, 20)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[2] == w[2] and g[3] == w[3]
        assert (g[1] is None) == (w[1] is None) and (g[1] is None or g[1] == pytest.approx(w[1]))
