import math
import random

import pytest
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import scalar as S
from wattline.operators import aggregates as A
from wattline.operators import clean, datasets, diagnostics, drift, evaluation, intervals
from wattline.operators.quantiles import value_series
from wattline.operators.series import Series
from wattline.streaming import stream as streams


def one(spark, expr, **values):
    cols = {k: F.lit(v) for k, v in values.items()}
    return spark.range(1).withColumns(cols).select(expr.alias("x")).first()[0] if cols else spark.range(1).select(expr.alias("x")).first()[0]


# ---- cleaning


def test_durations(spark):
    df = spark.createDataFrame([("1234:05:06",), ("5:06",), ("",), (None,), ("a:b:c",), ("99999999999999999:0:0",)], "t string")
    got = [r[0] for r in df.select(S.seconds_of("t")).collect()]
    assert got[:5] == [4442706.0, None, None, None, None] and got[5] > 1e20


def test_categories_times_and_numbers(spark):
    df = spark.createDataFrame([(" Enabled ",), ("OFF",), ("1.0",), ("maybe",), (None,)], "t string")
    assert [r[0] for r in df.select(S.category("t")).collect()] == [1, 0, 1, None, None]
    times = spark.createDataFrame([("05/02/2026 10:00:01",), ("2026-02-05 10:00:01",), ("5-2-2026 10:00:01.5",), ("x",), ("31/02/2026 00:00:00",)], "t string")
    got = [str(r[0]) if r[0] else None for r in times.select(S.parse_time("t").cast("string")).collect()]
    assert got == ["2026-02-05 10:00:01", "2026-02-05 10:00:01", "2026-02-05 10:00:01.5", None, None]
    nums = spark.createDataFrame([("1.5",), ("NaN",), ("n/a",), (None,)], "t string")
    assert [r[0] for r in nums.select(S.number("t")).collect()] == [1.5, None, None, None]


def test_fault_codes_are_cleaned(spark):
    df = spark.createDataFrame([(" AC-Hall  Failure! ",), ("___",), (None,)], "c string")
    assert [r[0] for r in df.select(S.fault_code("c")).collect()] == ["ac_hall_failure", "", None]


def test_validation_golden(spark):
    rows = [("01/01/2026 10:00:05", "0"), ("01/01/2026 10:00:03", "60"), ("bad", "300"), ("01/01/2026 10:00:01", "20")]
    df = spark.createDataFrame([("f", 0, i, t, "v", v, "50") for i, (t, v) in enumerate(rows)], "_file string, _block int, _row int, timestamp string, vehicle_id string, stack_voltage_v string, soc_pct string")
    out = clean.validate(df).orderBy("_row").collect()
    assert [(r["_row"], r["stack_voltage_v"], r["quality_flag"]) for r in out] == [(0, None, 0), (1, 60.0, 40), (3, None, 24)]
    # splits of a file are joined up: the same rows cut into blocks
    cut = df.withColumn("_block", F.col("_row"))
    assert [tuple(r)[3:] for r in clean.validate(cut).orderBy("_row").collect()] == [tuple(r)[3:] for r in out]
    report = clean.validation_report(clean.flagged(clean.parsed(df)), ["vehicle_id"]).first()
    assert report["bad_timestamps"] == 1 and report["time_reversal_rows"] == 1 and report["row_count_after_validation"] == 3
    assert report["soft_breaches_by_col"]["stack_voltage_v"] == 2 and report["hard_range_breaches"] == 1
    assert report["null_rates"]["stack_voltage_v"] == pytest.approx(2 / 3)
    with pytest.raises(ValueError, match="soc_pct"):
        clean.validate(df.drop("soc_pct"))


def test_standardize_keeps_unknown_columns(spark):
    df = spark.createDataFrame([("on", "1:00:00", "z")], "`MCU Enable State` string, `Last Trip Hours` string, extra string")
    assert clean.standardize(df).first().asDict() == {"mcu_enable_state": 1, "extra": "z", "last_trip_hours_s": 3600.0}


# ---- expressions


def test_safe_ratio(spark):
    for num, den, want in ((5.0, -0.4, None), (5.0, -0.5, 10.0), (20.0, 1.0, 10.0), (-3.0, -2.0, -1.5), (None, 2.0, None)):
        assert one(spark, S.safe_ratio(F.lit(num).cast("double"), F.lit(den), 0.5)) == want


def test_flags_and_columns(spark):
    df = spark.createDataFrame([(None, 10.0), (6.0, 20.0), (6.0, 60.0)], "battery_current_a double, motor_speed_rpm double")
    out = [(r["is_charging_current"], r["is_parked_charging"]) for r in df.withColumns(S.charging_flags()).collect()]
    assert out == [(0, 0), (1, 1), (1, 0)]
    assert S.ordered_columns(df.withColumn("a", F.lit(1)), ["motor_speed_rpm", "nope"]).columns == ["motor_speed_rpm", "a", "battery_current_a"]
    assert S.physics(df).columns == df.columns
    assert S.choose_features(df.withColumn("t", F.lit("x")), {"motor_speed_rpm"}) == ["battery_current_a"]
    assert [r[0] for r in df.select(S.truthy("battery_current_a")).collect()] == [False, True, True]


# ---- evaluation


def test_metrics_golden(spark):
    df = spark.createDataFrame([(0.5, 1.0, 20.0), (50.0, 51.0, 100.0)], "y double, pred double, now double")
    assert evaluation.regression_metrics(df.limit(1), "y", "pred").first()["mape"] == 50.0
    assert [r["soc_bucket"] for r in evaluation.bucket_metrics(df, "y", "pred", "now").collect()] == ["20–40%"]
    for mae, gap, want in ((0.4, 0.5, "ACCEPTABLE"), (0.4, 0.4, "EXCELLENT"), (1.5, 0, "INVESTIGATE"), (2.0, 0, "FAILING")):
        assert one(spark, evaluation.status_label(F.lit(mae), F.lit(gap))) == want
    slices = {r["slice"]: r["n"] for r in evaluation.slice_metrics(df, "y", "pred", "now").collect()}
    assert slices == {"charging": 0, "discharging": 2, "flat": 0}
    clipped = evaluation.scored(spark.createDataFrame([(1.0, None), (1.0, 150.0)], "y double, pred double"), "y").collect()
    assert [(r["pred"], r["error"]) for r in clipped] == [(None, None), (100.0, 99.0)]


# ---- drift


def test_population_stability_modes(spark):
    import numpy as np

    rng = random.Random(1)
    a, b = ([rng.gauss(50, 10) for _ in range(10000)] for _ in range(2))
    old, new = (spark.createDataFrame([(x,) for x in v], "x double") for v in (a, b))

    def index(ref, cuts):
        r, n = (np.histogram(v, cuts)[0] / len(v) for v in (ref, b))
        r, n = (np.where(v == 0, 1e-6, v) for v in (r, n))
        return float(((n - r) * np.log(n / r)).sum())

    at = [0.1, 0.25, 0.5, 0.75, 0.9]
    points = np.interp(np.linspace(0, 1, 1000), at, np.quantile(a, at))
    tenths = np.linspace(0, 1, 11)
    open_cuts = np.quantile(a, tenths)
    open_cuts[0], open_cuts[-1] = -np.inf, np.inf
    base = drift.baseline(old, ["x"])
    sketch = drift.drift_report(base, new).first()
    sample = drift.drift_report(base, new, old).first()
    # a sketch overstates drift: these two samples have the same distribution
    assert sketch["status"] == "DRIFT"
    assert sketch["psi"] == pytest.approx(index(points, np.unique(np.quantile(points, tenths))), abs=1e-4)
    assert sample["status"] == "STABLE" and sample["psi"] == pytest.approx(index(a, open_cuts), abs=1e-4)
    few = drift.drift_report(base, new.limit(9), old).first()
    assert few["status"] == "INSUFFICIENT_DATA" and few["psi"] is None
    summary = drift.drift_summary(drift.drift_report(base, new.limit(9), old)).first()
    assert summary["features_checked"] == 1 and summary["overall_status"] == "STABLE"


def test_ks_equals_the_definition(spark):
    rng = random.Random(2)
    a = [round(rng.gauss(0, 1), 2) for _ in range(300)]
    b = [round(rng.gauss(0.3, 1), 2) for _ in range(200)]
    d = max(abs(sum(v <= x for v in a) / 300 - sum(v <= x for v in b) / 200) for x in a + b)
    frame = lambda v: spark.createDataFrame([("f", x) for x in v], "feature string, value double")
    r = drift.ks(drift.paired_counts(frame(a), frame(b)), value_series(frame(a + b), ["feature"]), exact_upto=0).first()
    assert r["ks_stat"] == pytest.approx(d)
    assert r["ks_pvalue"] == pytest.approx(drift.kolmogorov(math.sqrt(300 * 200 / 500) * d))


def test_baseline_keeps_empty_features(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    rows = {r["feature"]: r for r in drift.baseline(df, ["a", "b", "absent"]).collect()}
    assert rows["a"]["p50"] == 2.0 and rows["b"]["n"] == 0 and rows["b"]["null_rate"] == 1.0 and len(rows) == 2


def test_flat_reference_has_no_psi(spark):
    old = spark.createDataFrame([(1.0,)] * 20, "x double")
    new = spark.createDataFrame([(5.0,)] * 20, "x double")
    assert drift.drift_report(drift.baseline(old, ["x"]), new, old).first()["psi"] == 0.0


# ---- datasets


def test_last_trips_need_some_left(spark):
    df = spark.createDataFrame([(f"t{i:02d}", i) for i in range(15)], "trip_id string, s long").withColumn("timestamp", F.timestamp_seconds("s"))
    with pytest.raises(Exception, match="not enough trips"):
        datasets.split_last_trips(df, 20).collect()
    with pytest.raises(Exception, match="not enough trips"):
        datasets.split_last_trips(df, 15).collect()
    out = datasets.split_last_trips(df, 4)
    assert {r["trip_id"] for r in out.where("split = 'val'").collect()} == {"t11", "t12", "t13", "t14"}
    assert out.count() == 15


def test_micro_trips_keep_both_bounds(spark):
    rows = [("a", i * 3.0 / 59) for i in range(60)] + [("b", 0.0)] * 60 + [("c", float(i)) for i in range(59)]
    df = spark.createDataFrame(rows, "trip_id string, soc_pct double")
    assert {r[0] for r in A.filter_micro_trips(df, ["trip_id"], "soc_pct").select("trip_id").distinct().collect()} == {"a"}
    assert {r["trip_id"] for r in A.micro_trips(df, ["trip_id"], "soc_pct").collect()} == {"b", "c"}


def test_training_rows_fail_on_absent_columns(spark):
    df = spark.createDataFrame([(1.0, 1, 0)], "a double, label_available int, quality_flag int")
    with pytest.raises(ValueError, match="target"):
        datasets.training_rows(df, ["a"], "target", 52)


# ---- intervals, diagnostics


def test_pre_event_window_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), round(rng.uniform(0, 5000), 1), rng.uniform(-5, 5) if rng.random() < 0.8 else None) for _ in range(1500)]
    faults = [(rng.choice("ab"), i, round(rng.uniform(0, 5000), 1)) for i in range(60)] + [("a", 99, rows[0][1])]
    stamp = lambda c: F.timestamp_micros((F.col(c) * 1e6).cast("long"))
    df = spark.createDataFrame(rows, "k string, t double, x double").withColumn("ts", stamp("t"))
    ev = spark.createDataFrame(faults, "k string, id int, at double").withColumn("activated_at", stamp("at"))
    out = intervals.pre_event_stats(df, ev, Series("k", "ts"), ["x"], "id", "activated_at", before_s=300, min_rows=10)
    got = {r["id"]: (r["pre_rows"], r["x_pre_mean"]) for r in out.collect()}
    want = {}
    for k, i, at in faults:
        pre = [x for kk, t, x in rows if kk == k and round((at - 300) * 1e6) <= round(t * 1e6) < round(at * 1e6)]
        if len(pre) >= 10:
            have = [x for x in pre if x is not None]
            want[i] = (len(pre), sum(have) / len(have))
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1])


def test_fault_log_rules(spark):
    rows = [("a", 5, 9, "X"), ("a", 5, 3, "inverted"), ("a", None, 3, "y"), ("a", 1, None, "z"), ("a", 1, 2, None), ("a", 1, 2, "!!")]
    df = spark.createDataFrame(rows, "k string, a long, b long, code string").select(
        "k", F.timestamp_seconds("a").alias("activated_at"), F.timestamp_seconds("b").alias("fixed_at"), "code"
    )
    out = intervals.clean_faults(df)
    assert {r["code"] for r in out.collect()} == {"x", "z"}
    assert set(intervals.fault_codes(out)) == {*C.KNOWN_FAULT_CODES, "x", "z"}


def test_contradictions(spark):
    df = spark.createDataFrame([(301.0, 0.05, 9.0), (301.0, 5.0, 0.0), (301.0, 5.0, 5.0), (300.0, 0.0, 0.0), (400.0, None, 5.0)], "motor_speed_rpm double, output_power_kw double, battery_current_a double")
    assert diagnostics.contradictions(df).count() == 2


# ---- streaming


def test_streamed_trips_equal_batch(spark, folder):
    rng = random.Random(8)
    rows, t = [], {"a": 0, "b": 0}
    for _ in range(600):
        k = rng.choice("ab")
        t[k] += rng.choice([1, 1, 1, 2, 31, 30])
        rows.append((k, t[k]))
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    ordered = df.orderBy("ts").collect()
    for i in range(6):  # six files in time order: six batches
        spark.createDataFrame(ordered[i * 100 : (i + 1) * 100], df.schema).coalesce(1).write.parquet(f"{folder}/in/f={i}")
    for _ in range(2):  # a second start finds nothing new and changes nothing
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")
        closed = streams.session_stream(stream, "k", "ts", 29, "100 seconds")
        streams.trip_stream(closed, "k", f"{folder}/out", f"{folder}/cp", min_rows=2).awaitTermination()
        got = {(r["trip_id"], r["rows"]) for r in spark.read.parquet(f"{folder}/out/trips").collect()}
    whole = streams.session_stream(df, "k", "ts", 29, "100 seconds")
    named, counters = streams.number_trips(whole, "k", None, 2)
    mark = max(t.values()) - 100
    want = {(r["trip_id"], r["rows"]) for r in named.collect() if r["trip_end_ts"].timestamp() + 30 <= mark}
    assert got == want and len(want) > 5
    assert {r["k"] for r in counters.collect()} == {"a", "b"}


def test_streamed_validation(spark, folder):
    raw = spark.createDataFrame([("01/02/2026 00:00:00", "150", "x"), ("bad", "5", "y")], "`Timestamp` string, `SOC (%)` string, vehicle_id string")
    raw.write.parquet(f"{folder}/raw")
    stream = spark.readStream.schema(raw.schema).parquet(f"{folder}/raw")
    valid = streams.validate_stream(stream)
    q = streams.each_batch(valid, lambda d, i: d.write.mode("overwrite").parquet(f"{folder}/valid/b={i}"), f"{folder}/cp")
    q.awaitTermination()
    rows = spark.read.parquet(f"{folder}/valid").collect()
    assert [(r["soc_pct"], r["quality_flag"]) for r in rows] == [(None, 24)]


def test_worst_row_with_text_and_time_ties(spark):
    df = spark.createDataFrame([(3.0, "b", 1), (3.0, "a", 2), (1.0, "c", 3)], "abs_error double, k string, v int")
    assert evaluation.worst_row(df, ties=["k"]).first()["v"] == 2
    assert evaluation.worst_row(df.withColumn("t", F.timestamp_seconds("v")), ties=["t"]).first()["v"] == 1
