from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from telemetry import write_day

from wattline import config as C
from wattline.operators import model
from wattline.plans import jobs
from wattline.sources import tables as IO

DAYS = ["2026-02-23", "2026-02-24", "2026-02-25"]
VEHICLES = ["007", "EV01"]
QUICK = jobs.Settings(forecast=replace(C.ForecastConfig(), max_iter=2, max_depth=2))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for d, day in enumerate(DAYS):
        for v, vehicle in enumerate(VEHICLES):
            write_day(root / "raw", root / "raw_faults", day, vehicle, seed=10 * d + v)
    lake = jobs.Lake(str(root))
    jobs.ingest(spark, lake, DAYS[:2], QUICK)
    jobs.ingest(spark, lake, DAYS[2:], QUICK)
    jobs.gold(spark, lake, DAYS, QUICK, wanted=C.FORECAST_FEATURES)
    return lake


def test_raw_rows_are_validated(spark, lake):
    raw = IO.read_table(spark, lake.at("raw_parquet"))
    assert dict(raw.dtypes)["vehicle_id"] == "string"
    assert {r[0] for r in raw.select("vehicle_id").distinct().collect()} == set(VEHICLES)
    bits = raw.groupBy("dt", "vehicle_id").agg(
        F.count_if(F.col("quality_flag").bitwiseAND(C.HARD_RANGE_BREACH) != 0).alias("hard"),
        F.count_if(F.col("quality_flag").bitwiseAND(C.TIME_ANOMALY) != 0).alias("odd"),
        F.count_if(F.col("stack_voltage_v").isNull()).alias("no_voltage"),
    )
    for r in bits.collect():
        assert r["hard"] >= 1 and r["odd"] >= 1 and r["no_voltage"] == 2
    assert raw.where(F.col("timestamp").isNull()).count() == 0
    assert raw.where(F.col("total_running_hours_s") >= 360000).count() == raw.count()


def test_silver_is_a_regular_grid(spark, lake):
    silver = IO.read_table(spark, lake.at("silver"))
    per = silver.groupBy("dt", "vehicle_id").agg(
        F.count("*").alias("n"),
        F.count_distinct("timestamp").alias("ticks"),
        (F.max(F.unix_seconds("timestamp")) - F.min(F.unix_seconds("timestamp")) + 1).alias("span"),
    )
    rows = per.collect()
    assert len(rows) == 6
    for r in rows:
        assert r["n"] == r["ticks"] == r["span"]
    assert {"fault_ac_hall_failure", "fault_new_code_7", "fault_total_hardware_failure", "fault_any"} <= set(silver.columns)
    assert "fault_inverted" not in silver.columns
    counts = silver.groupBy("dt", "vehicle_id").agg(
        F.sum("fault_ac_hall_failure").alias("a"), F.sum("fault_new_code_7").alias("b")
    )
    assert {(r["a"], r["b"]) for r in counts.collect()} == {(61, 11)}


def test_trips_run_on_over_files_and_batches(spark, lake):
    silver = IO.read_table(spark, lake.at("silver"), vehicles=["EV01"])
    trips = silver.where("trip_id is not null").groupBy("dt").agg(
        F.sort_array(F.collect_set("trip_id")).alias("ids")
    )
    ids = {r["dt"]: r["ids"] for r in trips.collect()}
    assert ids[DAYS[0]] == ["EV01_000001", "EV01_000002"]
    # the second trip of a day is open at its end and goes on the next day, also in a new batch
    assert ids[DAYS[1]] == ["EV01_000002", "EV01_000003"]
    assert ids[DAYS[2]] == ["EV01_000003", "EV01_000004"]
    state = spark.read.parquet(lake.at(f"state/trips/as_of={DAYS[2]}")).where("vehicle_id = 'EV01'").first()
    assert (state["trip_seq"], state["open_trip_id"]) == (4, "EV01_000004")


def test_a_rerun_changes_nothing(spark, lake):
    before = [tuple(r) for r in IO.read_table(spark, lake.at("silver")).orderBy("dt", "vehicle_id", "timestamp").collect()]
    jobs.ingest(spark, lake, DAYS[2:], QUICK)
    spark.catalog.clearCache()
    after = [tuple(r) for r in IO.read_table(spark, lake.at("silver")).orderBy("dt", "vehicle_id", "timestamp").collect()]
    assert before == after


def test_the_middle_day_of_a_batch_can_be_run_again(spark, lake):
    def trips():
        rows = IO.read_table(spark, lake.at("silver")).groupBy("dt", "vehicle_id", "trip_id").count().collect()
        return sorted(map(tuple, rows), key=str)

    before = trips()
    jobs.ingest(spark, lake, DAYS[1:2], QUICK)
    spark.catalog.clearCache()
    assert trips() == before


def test_gold_tables(spark, lake):
    rows = IO.read_table(spark, lake.at("gold/window_features"))
    assert set(C.FORECAST_FEATURES) - {"is_charging_current", "is_parked_charging"} <= set(rows.columns)
    assert rows.where(F.col("quality_flag").bitwiseAND(48) != 0).count() == 0
    daily = IO.read_table(spark, lake.at("gold/daily_stats"))
    for r in daily.collect():
        assert r["silver_rows"] == r["rows_after_quality_filter"] + r["dropped_rows"]
        assert r["window_feature_rows"] + r["dropped_unrealistic_target_rows"] == r["rows_after_quality_filter"]
        assert r["status"] == "success" and r["trip_count"] == 2
    trips = IO.read_table(spark, lake.at("gold/trip_features"))
    assert trips.count() == 12
    assert trips.where("energy_kwh_proxy is not null and duration_s + 1 >= rows").count() == 12
    # the first trip of a day ends in unfilled padding rows: its last reading is NULL
    assert trips.where("soc_delta < 0").count() == 6 and trips.where("soc_end is null").count() == 6


def test_train_evaluate_and_drift(spark, lake):
    path = jobs.train(spark, lake, DAYS[:1], DAYS[1:2], settings=QUICK)
    name = Path(path).name
    assert name.startswith(f"v1__{DAYS[0]}__")
    run = model.load_run(spark, lake.at("models"), "soc_forecast")
    assert run.run_id == name and run.features == list(C.FORECAST_FEATURES)
    summary = spark.read.json(f"{path}/eval_report/summary").first()
    assert summary["train_rows"] > 0 and summary["val_rows"] > 0
    stamp = model.read_object(spark, f"{path}/data_fingerprint")
    assert stamp["train_trips"] > 0 and stamp["train_days"] == DAYS[:1]
    hashes = spark.read.json(f"{path}/file_hashes")
    assert hashes.count() >= 4 and hashes.where("sha256 like 'sha256:%' and length(sha256) = 23").count() == hashes.count()

    out = jobs.evaluate(spark, lake, DAYS[2], settings=QUICK, reference_days=DAYS[:1])
    assert out["summary"].first()["val_rows"] > 0
    assert out["drift_summary"].first()["features_checked"] == len(C.FORECAST_FEATURES)
    sketch = jobs.check_drift(spark, lake, DAYS[2], settings=QUICK)
    assert sketch.count() == len(C.FORECAST_FEATURES)
    second = jobs.train(spark, lake, DAYS[:1], DAYS[1:2], settings=QUICK)
    assert Path(second).name.startswith("v2__")
    with pytest.raises(FileNotFoundError):
        model.load_run(spark, lake.at("models"), "soc_forecast", "v9__x__00000000")


def test_study_writes_its_tables(spark, lake):
    out = jobs.study(spark, lake, DAYS[0], ["EV01", "007"], n_val=1, settings=QUICK)
    assert out["split_summary"].count() == 2
    back = spark.read.option("header", True).csv(lake.at(f"reports/study/dt={DAYS[0]}/val_predictions"))
    assert back.count() == out["val_predictions"].count() > 0
    report = spark.read.option("header", True).csv(lake.at(f"reports/study/dt={DAYS[0]}/feature_constant_report"))
    assert report.count() == len(C.FORECAST_FEATURES)
    with pytest.warns(UserWarning, match="EV99"):
        jobs.load_training(spark, lake, DAYS[:1], ["EV01", "EV99"], QUICK.forecast)


def test_fingerprints_are_sha256(spark, lake):
    import hashlib

    out = {r["file"]: r["sha256"] for r in IO.fingerprints(spark, lake.at("gold/trip_features"), DAYS[:1], ["EV01"]).collect()}
    files = list(Path(lake.at(f"gold/trip_features/dt={DAYS[0]}/vehicle_id=EV01")).glob("*.parquet"))
    assert len(out) == len(files) > 0
    for f in files:
        key = f"dt={DAYS[0]}/vehicle_id=EV01/{f.name}"
        assert out[key] == "sha256:" + hashlib.sha256(f.read_bytes()).hexdigest()[:16]


def test_a_range_of_days():
    assert jobs.day_range("2026-02-27", "2026-03-01") == ["2026-02-27", "2026-02-28", "2026-03-01"]
    with pytest.raises(ValueError):
        jobs.day_range("2026-03-01", "2026-02-27")


def test_partitions_without_rows_are_replaced(spark, folder):
    df = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 2), ("d2", "a", 3)], "dt string, vehicle_id string, x int")
    IO.write_table(df, folder + "/t")
    import time

    time.sleep(2.5)
    IO.write_table(df.where("vehicle_id = 'a' and dt = 'd1'"), folder + "/t", ["d1"])
    left = {(r["dt"], r["vehicle_id"]) for r in IO.read_table(spark, folder + "/t").collect()}
    assert left == {("d1", "a"), ("d2", "a")}
    missing = IO.missing_files(IO.read_table(spark, folder + "/t"), ["d1", "d2"], ["a", "b"])
    assert {tuple(r) for r in missing.collect()} == {("d1", "b"), ("d2", "b")}


def test_file_names_and_headers_are_checked(spark, folder):
    base = Path(folder) / "raw" / "dt=2026-01-01"
    base.mkdir(parents=True)
    (base / "car.csv").write_text("Timestamp,SOC (%)\n01/01/2026 00:00:00,5\n")
    with pytest.raises(Exception, match="cannot read a vehicle id"):
        IO.read_raw(spark, folder + "/raw").select("vehicle_id").collect()
    with pytest.raises(FileNotFoundError):
        IO.read_raw(spark, folder + "/raw", ["2030-01-01"])
    other = Path(folder) / "mixed" / "dt=2026-01-01"
    other.mkdir(parents=True)
    (other / "vehicle_id=a.csv").write_text("Timestamp,SOC (%)\n01/01/2026 00:00:00,5\n")
    (other / "vehicle_id=b.csv").write_text("SOC (%),Timestamp\n5,01/01/2026 00:00:00\n")
    (other / "vehicle_id=c.csv").write_text("SOC (%),Timestamp,Speed\n6,01/01/2026 00:00:01,70\n7,02/01/2026 00:00:01,71\n")
    rows = {(r["vehicle_id"], r["SOC (%)"], r["Timestamp"], r["Speed"]) for r in IO.read_raw(spark, folder + "/mixed").collect()}
    assert rows == {
        ("a", "5", "01/01/2026 00:00:00", None), ("b", "5", "01/01/2026 00:00:00", None),
        ("c", "6", "01/01/2026 00:00:01", "70"), ("c", "7", "02/01/2026 00:00:01", "71"),
    }


def test_time_formats_reach_the_rows(spark, folder):
    write_day(Path(folder) / "raw", Path(folder) / "raw_faults", "2026-02-23", "EV01", seed=1)
    for f in Path(folder).glob("raw/**/*.csv"):
        lines = f.read_text().splitlines()
        f.write_text("\n".join([lines[0], *("unreadable," + x.split(",", 1)[1] for x in lines[1:])]) + "\n")
    lake = jobs.Lake(folder)
    assert jobs.ingest(spark, lake, ["2026-02-23"], QUICK).collect() is not None  # no readable row is no error


def test_day_folders_are_the_only_ones_read(spark, folder):
    df = spark.createDataFrame([("d1", "a", 1), ("d2", "b", 2), ("d3", "007", 3)], "dt string, vehicle_id string, x int")
    IO.write_table(df, folder + "/t", ["d1", "d2", "d3"])
    one = IO.read_table(spark, folder + "/t", ["d2", "d9"])
    assert [tuple(r) for r in one.select("dt", "vehicle_id", "x").collect()] == [("d2", "b", 2)]
    assert one.inputFiles() and all("/dt=d2/" in f for f in one.inputFiles())
    assert IO.read_table(spark, folder + "/t", first_day="d2", vehicles=["007"]).first()["x"] == 3
    with pytest.raises(FileNotFoundError):
        IO.read_table(spark, folder + "/t", ["d9"])
    assert IO.read_table(spark, folder + "/t", ["d9"], schema=df.schema).count() == 0
    assert IO.fingerprints(spark, folder + "/t", ["d1"], ["a", "b"]).count() == 1
