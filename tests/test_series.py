"""Long series give the same rows as short ones: every ordered operator, cut and uncut."""

import random

import pytest
from pyspark.sql import functions as F

from wattline.operators import datasets, drift, evaluation, intervals, quantiles, sessions, windows
from wattline.operators.series import Series, measure, positions


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of all rows; there is a NULL key; times come in bursts."""
    rng, out, t = random.Random(5), [], {}
    for i in range(6000):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", "d", None])
        step = rng.choice([0, 1, 1, 2, 7, 400]) if rng.random() < 0.3 else 1
        t[key] = t.get(key, 0) + step
        out.append((key, t[key], i, None if rng.random() < 0.1 else round(rng.uniform(0, 100), 2)))
    df = spark.createDataFrame(out, "k string, s long, id long, x double")
    df = df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    return df.repartition(5).cache()


WHOLE = Series("k", "ts", "id")
CUT = Series("k", "ts", "id", max_rows=300)
OPERATORS = {
    "positions": lambda d, s: positions(d, s),
    "sessions": lambda d, s: sessions.sessions(d, s, 300, min_rows=20),
    "spans": lambda d, s: sessions.spans(d.where("x > 50"), s, 5),
    "rising": lambda d, s: sessions.rising_spans(d, s, "x"),
    "sliding": lambda d, s: windows.rolling(d, s, ["x"], [3, 7], min_periods=2),
    "joined": lambda d, s: windows.rolling(d, s, ["x"], [20, 60], min_periods=3),
    "lags": lambda d, s: windows.lags(d, s, ["x"], [1, 60, 700]),
    "label": lambda d, s: windows.future_label(d, s, "x", 45, "y", 30.0),
    "rate": lambda d, s: windows.change_rate(d, s, "x", "r"),
    "elapsed": lambda d, s: windows.elapsed(d, s),
    "band": lambda d, s: windows.error_band(d.withColumns({"pred": F.col("x"), "error": F.col("x") - 3}), s),
    "all": lambda d, s: windows.window_features(d, s, ["x"], [5, 30], ["mean", "std", "min", "max"], [1, 9], "x", 12, "y"),
}


def exact(df):
    return df.select(*[F.round(c, 7).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.mark.parametrize("name", OPERATORS)
def test_cut_series_give_the_same_rows(rows, name):
    assert measure(rows, CUT).long.count() >= 2
    whole = exact(OPERATORS[name](rows, WHOLE)).collect()
    cut = exact(OPERATORS[name](rows, CUT).select(*OPERATORS[name](rows, WHOLE).columns)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, cut))
    assert len(whole) > 10


def test_short_series_need_one_shuffle(spark):
    from conftest import SF

    df = spark.read.parquet(f"{SF}/events.parquet")
    out = windows.window_features(
        df, Series("user_id", "ts", "event_id"), ["value"], [30, 60], ["mean", "std", "min", "max"], [5, 60], "value", 30, "y"
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1 and "Union" not in plan


def test_long_series_list_is_bounded_and_measured_once(rows):
    s = measure(rows, CUT)
    assert s.measured and s.long.count() <= 6
    assert measure(rows, WHOLE).long is None


def test_a_grid_is_measured_before_it_exists(spark):
    df = spark.sql("SELECT 'a' AS k, timestamp_seconds(id * 1000) AS ts FROM range(2)")
    assert measure(df, Series("k", "ts", max_rows=900)).long is None
    assert measure(df, Series("k", "ts", max_rows=900), step=1_000_000).long.count() == 1


def test_joined_frames_equal_sliding_frames(rows):
    a = windows.rolling_columns(rows, WHOLE, ["x"], [2, 30, 47, 60, 300])
    b = windows.rolling_joined(rows, WHOLE, ["x"], [2, 30, 47, 60, 300])
    assert a.columns == b.columns
    assert sorted(map(str, exact(a).collect())) == sorted(map(str, exact(b).collect()))


def test_rolling_golden(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0])], "k int, t int, x double")
    out = windows.rolling(df, Series("k", "t"), ["x", "absent"], [3]).orderBy("t").collect()
    assert [r["x_roll_mean_3s"] for r in out] == [None] * 5 + [5.0]
    assert [round(r["x_roll_std_3s"], 6) if r["x_roll_std_3s"] is not None else None for r in out] == [None] * 5 + [0.816497]
    flat = spark.createDataFrame([(1, i, 0.1) for i in range(50)], "k int, t int, x double")
    stds = windows.rolling_joined(flat, Series("k", "t"), ["x"], [17]).select("x_roll_std_17s").dropna().distinct().collect()
    assert [tuple(r) for r in stds] == [(0.0,)]


def test_label_golden(spark):
    df = spark.createDataFrame([(1, 0, 50.0), (1, 1, 76.0), (2, 0, 50.0), (2, 1, 75.0)], "k int, t int, x double")
    out = windows.future_label(df, Series("k", "t"), "x", 1, "y", 25.0)
    assert {(r["k"], r["t"], r["y"], r["label_available"]) for r in out.collect()} == {
        (1, 1, None, 0), (2, 0, 75.0, 1), (2, 1, None, 0),
    }


def test_quantiles_cut_and_whole_equal_numpy(spark, rows):
    import numpy as np

    values = [r[0] for r in rows.select("x").dropna().collect()]
    cuts = {"p5": 0.05, "p50": 0.5, "p93": 0.93, "p100": 1.0}
    want = [float(np.quantile(values, p)) for p in cuts.values()]
    for size in (None, 100, 4_000_000):
        got = quantiles.exact_quantiles(rows, "x", cuts, max_rows=size).first()
        assert [round(v, 9) for v in got] == [round(v, 9) for v in want]
    by = quantiles.exact_quantiles(rows, "x", cuts, ["k"], max_rows=50).collect()
    for r in by:
        here = [v[0] for v in rows.where(F.col("k").eqNullSafe(F.lit(r["k"]))).select("x").dropna().collect()]
        assert round(r["p93"], 9) == round(float(np.quantile(here, 0.93)), 9)
    assert len(by) == 6


def test_drift_measures_cut_and_whole(rows):
    ref, new = (drift.feature_values(rows.where(c), ["x"]) for c in ("id < 3000", "id >= 2000"))
    pairs = drift.paired_counts(ref, new)
    whole, cut = (quantiles.value_series(ref.unionByName(new), ["feature"], max_rows=m) for m in (None, 200))
    assert whole.long is None and cut.long.count() == 1
    assert drift.ks(pairs, whole).first() == drift.ks(pairs, cut).first()
    assert drift.psi(pairs, drift.edges(pairs, whole), True).first() == drift.psi(pairs, drift.edges(pairs, cut), True).first()


def test_interval_flags_cut_and_whole(spark, rows):
    rows = rows.where("k is not null")
    faults = rows.where("id % 40 = 0").select(
        "k", F.col("ts").alias("activated_at"), F.timestamp_seconds(F.unix_seconds("ts") + 25).alias("fixed_at"), F.lit("f").alias("code")
    )
    flags = [
        intervals.interval_flags(rows, faults, s, ["f"]).select("id", "fault_f", "fault_any").collect() for s in (WHOLE, CUT)
    ]
    assert sorted(flags[0]) == sorted(flags[1])
    log = faults.collect()
    for r in intervals.interval_flags(rows, faults, CUT, ["f"]).collect():
        want = any(f["k"] == r["k"] and f["activated_at"] <= r["ts"] <= f["fixed_at"] for f in log)
        assert r["fault_f"] == int(want) == r["fault_any"]


def test_splits_cut_and_whole(rows):
    trips = rows.where("k is not null").withColumn("trip_id", F.concat("k", F.lit("-"), F.floor(F.unix_seconds("ts") / 50)))
    for f in (
        lambda m: datasets.split_by_share(trips, 0.2, ("trip_id",), "ts", max_rows=m),
        lambda m: datasets.split_shuffled(trips, 0.2, 7, ("trip_id",), max_rows=m),
    ):
        a, b = ({(r["id"], r["split"]) for r in f(m).select("id", "split").collect()} for m in (None, 10))
        assert a == b and {s for _, s in a} == {"train", "test"}


def test_histogram_matches_numpy(rows):
    import numpy as np

    values = [r[0] for r in rows.select("x").dropna().collect()]
    counts, edges = np.histogram(values, bins=17)
    out = evaluation.histogram(rows, "x", 17).orderBy("bin").collect()
    assert [r["rows"] for r in out] == counts.tolist()
    assert [round(r["bin_start"], 6) for r in out] == [round(float(e), 6) for e in edges[:-1]]


def chunk_sizes(df, series):
    from wattline.operators.series import _chunked

    chunks = _chunked(df, measure(df, series)).where("_chunk > 0")
    return [r["count"] for r in chunks.groupBy(*series.keys, "_chunk").count().collect()]


def test_chunks_hold_equal_numbers_of_rows(spark):
    rows = [("far", i, i, float(i)) for i in range(9_999)] + [("far", 10**9, 0, 1.0)]  # one far time
    rows += [("none", None if i % 2 else i, i, 1.0) for i in range(8_000)]  # half without a time
    rows += [("equal", i if i % 4 == 0 else 77, i, 1.0) for i in range(8_000)]  # most at one time
    rows += [(None, i // 3, i, 1.0) for i in range(5_000)] + [("short", i, i, 1.0) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t long, id long, x double")
    series = Series("k", "t", "id", max_rows=1000)
    sizes = chunk_sizes(df, series)
    assert sum(sizes) == 31_000 and max(sizes) <= 2 * 250
    values = spark.createDataFrame([(1, 0.001 * i) for i in range(9_999)] + [(1, 1e12)], "k int, v double")
    assert max(chunk_sizes(values, Series("k", "v", max_rows=1000))) <= 2 * 250
    whole = Series("k", "t", "id")
    for f in (positions, lambda d, s: windows.lags(d, s, ["x"], [1, 60])):
        assert sorted(map(str, f(df, series).select(*f(df, whole).columns).collect())) == sorted(map(str, f(df, whole).collect()))


def test_chained_operators_on_long_series_read_the_table_once_each(spark, rows):
    measured = measure(rows, CUT)

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("InMemoryTableScan")

    one = sessions.sessions(rows, measured, 300, min_rows=20)
    two = windows.window_features(one, measured, ["x"], [5], ["mean"], [1], "x", 12, "y")
    assert scans(one) == 0 and scans(two) == 0  # both read stored tables
    assert two.count() == windows.window_features(rows, WHOLE, ["x"], [5], ["mean"], [1], "x", 12, "y").count()


def test_cuts_in_levels_keep_arrays_short(spark, monkeypatch):
    from wattline.operators import series as cuts

    monkeypatch.setattr(cuts, "FAN", 8)
    rows = [("far", 7 * i, i, float(i)) for i in range(9_999)] + [("far", 10**9, 0, 1.0)]
    rows += [("equal", i if i % 4 == 0 else 77, i, 1.0) for i in range(8_000)]  # most at one time
    rows += [("none", None if i % 2 else i, i, 1.0) for i in range(8_000)] + [("short", i, i, 1.0) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, t long, id long, x double")
    series = Series("k", "t", "id", max_rows=400)
    found = measure(df, series)
    bounds = [found.long, *found.levels, *(b for _, b in found.finer)]
    assert max(b.agg(F.max(F.size("_bounds"))).first()[0] for b in bounds) <= 8
    assert len(found.levels) == 2 and len(found.finer) == 2
    assert max(chunk_sizes(df, series)) <= 2 * 100
    for f in (positions, lambda d, s: windows.lags(d, s, ["x"], [1, 60])):
        whole = f(df, Series("k", "t", "id"))
        assert sorted(map(str, f(df, series).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
