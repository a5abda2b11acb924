"""Trips from keyed state, and the load as files arrive."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from telemetry import write_day

from wattline import config as C
from wattline.operators import sessions as T
from wattline.operators.series import Series
from wattline.plans import jobs
from wattline.sources import tables as IO
from wattline.streaming import loads
from wattline.streaming import trips as state_trips
from wattline.streaming.trips import TripProcessor

START = datetime(2026, 3, 1)
ROWS = "k string, ts timestamp, n int"


def made_rows(rng, seconds=4000):
    out = []
    for key, share in (("a", 0.6), ("b", 0.2), ("c", 0.02)):
        for s in range(seconds):
            if rng.random() < share and not 1500 <= s < 1500 + 40 * len(out) % 200:
                out += [(key, START + timedelta(seconds=s), s)] * (2 if rng.random() < 0.05 else 1)
    return out


def in_late_order(rng, rows, late_s=50):
    return sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.uniform(0, late_s)))


def run(spark, folder, delay="100 seconds", gap=29, min_rows=3):
    stream = spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(f"{folder}/in")
    found = state_trips.trip_events(stream, "k", "ts", gap, delay, min_rows=min_rows)
    state_trips.write_trip_events(found, f"{folder}/out", f"{folder}/cp").awaitTermination()
    return state_trips.current_trips(spark, f"{folder}/out", "k")


def batch_trips(spark, rows, gap=29, min_rows=3):
    df = T.sessions(spark.createDataFrame(rows, ROWS), Series("k", "ts", "n"), gap, min_rows=min_rows).where("trip_id IS NOT NULL")
    found = df.groupBy("k", "trip_id").agg(F.min("ts"), F.max("ts"), F.count("*")).collect()
    return {tuple(r) for r in found}


def test_states_equal_batch_for_late_rows_and_restarts(spark, folder):
    rng = random.Random(4)
    rows = made_rows(rng)
    ordered = in_late_order(rng, rows)
    shown = Counter()
    for i in range(5):
        part = ordered[i * len(ordered) // 5 : (i + 1) * len(ordered) // 5]
        rng.shuffle(part)
        spark.createDataFrame(part, ROWS).write.parquet(f"{folder}/in/{i}")
        now = run(spark, folder)
        shown.update(r.status for r in now.collect())
        # what is shown is what a batch over the final rows finds
        limit = max(r[1] for p in range(i + 1) for r in ordered[p * len(ordered) // 5 : (p + 1) * len(ordered) // 5]) - timedelta(seconds=100)
        want = batch_trips(spark, [r for r in rows if r[1] <= limit])
        assert {(r.k, r.trip_id, r.trip_start_ts, r.trip_end_ts, r.rows) for r in now.collect()} == want
        for r in now.collect():
            assert (r.status == "closed") == (r.trip_end_ts + timedelta(seconds=30) <= limit + timedelta(microseconds=1))
    assert shown["closed"] and shown["opened"] + shown["grown"]
    # a last row far ahead ends all trips
    spark.createDataFrame([("z", START + timedelta(days=1), 0)], ROWS).write.parquet(f"{folder}/in/last")
    done = run(spark, folder)
    assert {(r.k, r.trip_id, r.trip_start_ts, r.trip_end_ts, r.rows) for r in done.collect()} == batch_trips(spark, rows)
    assert {r.status for r in done.collect()} == {"closed"}


def test_rows_behind_the_watermark_and_without_key_change_nothing(spark, folder):
    rows = [("a", START + timedelta(seconds=s), s) for s in range(100)] + [(None, START, 1), ("a", None, 2)]
    spark.createDataFrame(rows, ROWS).write.parquet(f"{folder}/in/0")
    spark.createDataFrame([("b", START + timedelta(seconds=900), 0)], ROWS).write.parquet(f"{folder}/in/1")
    run(spark, folder)
    before = set(run(spark, folder).collect())
    spark.createDataFrame([("a", START + timedelta(seconds=50), 0)], ROWS).write.parquet(f"{folder}/in/2")
    assert set(run(spark, folder).collect()) == before
    assert {(r.k, r.status, r.rows) for r in before} == {("a", "closed", 100)}


class Kept:
    """State in memory, in place of the handle's."""

    def __init__(self):
        self.value, self.items, self.timers = None, [], []

    def getValueState(self, *_):  # noqa: N802
        return self

    getListState = getValueState  # noqa: N815

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v


def test_a_trip_opens_grows_and_closes():
    class Pending(Kept):
        def get(self):
            return iter(self.items)

        def clear(self):
            self.items = []

        def put(self, items):
            self.items = items

    class Handle(Kept):
        def getListState(self, *_):  # noqa: N802
            return Pending()

        def getValueState(self, *_):  # noqa: N802
            return Kept()

        def listTimers(self):  # noqa: N802
            return list(self.timers)

        def deleteTimer(self, t):  # noqa: N802
            self.timers.remove(t)

        def registerTimer(self, t):  # noqa: N802
            self.timers.append(t)

    handle, p = Handle(), TripProcessor(10_000, 2)
    p.init(handle)

    def step(times, watermark_ms):
        return [tuple(r) for part in p.fold(("k",), Counter(times), watermark_ms) for r in part.itertuples(index=False)]

    assert step([1000, 2000, 9000], 0) == [] and handle.timers == [1]
    assert step([], 1) == [] and handle.timers == [2]
    assert step([], 2) == [("k", 1, "opened", 1000, 2000, 2)]
    assert step([18_999], 18) == [("k", 1, "grown", 1000, 9000, 3)]
    assert step([28_999], 30) == [("k", 1, "closed", 1000, 18_999, 4)]
    assert handle.timers == [39]  # the second trip has one row so far
    assert step([], 39) == [] and handle.timers == []
    assert step([50_000, 51_000], 51) == [("k", 3, "opened", 50_000, 51_000, 2)]


# ---- loads

DAYS = ["2026-02-23", "2026-02-24", "2026-02-25"]
QUICK = jobs.Settings(forecast=replace(C.ForecastConfig(), max_iter=2, max_depth=2))


def put(root, day, vehicle, seed):
    write_day(root / "raw", root / "raw_faults", day, vehicle, seed=seed, seconds=900)


def silver_rows(spark, lake):
    spark.catalog.clearCache()
    rows = IO.read_table(spark, lake.at("silver"))
    rows = rows.select("dt", "vehicle_id", "timestamp", "trip_id", "soc_pct", "quality_flag", "fault_any")
    return sorted(map(tuple, rows.collect()), key=str)


class StoppedError(Exception):
    pass


def test_three_drops_equal_one_batch(spark, tmp_path):
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    files = [(DAYS[0], "007", 1), (DAYS[0], "EV01", 2), (DAYS[1], "007", 3), (DAYS[1], "EV01", 4), (DAYS[2], "EV01", 5), (DAYS[0], "EV02", 6)]
    for f in files:
        put(whole, *f)
    jobs.ingest(spark, jobs.Lake(str(whole)), DAYS, QUICK)
    lake, calls = jobs.Lake(str(parts)), []

    def ingest(spark, lake, days, settings):
        calls.append(list(days))
        out = jobs.ingest(spark, lake, days, settings)
        if len(calls) == 2:  # the second drop fails between its write and its record
            raise StoppedError
        return out

    load = lambda: loads.load_new_files(spark, lake, settings=QUICK, ingest=ingest).awaitTermination()
    for f in files[:2]:
        put(parts, *f)
    load()
    for f in files[2:4]:
        put(parts, *f)
    with pytest.raises(Exception, match="StoppedError"):
        load()
    load()
    for f in files[4:]:  # a new day, and a file that is late by two days
        put(parts, *f)
    load()
    load()  # nothing is new
    assert calls == [DAYS[:1], DAYS[1:2], DAYS[1:2], DAYS]
    assert silver_rows(spark, lake) == silver_rows(spark, jobs.Lake(str(whole)))
    records = {r.batch: r for r in loads.load_records(spark, lake).collect()}
    assert [(records[b]["files"], records[b].new_days) for b in sorted(records)] == [(2, DAYS[:1]), (2, DAYS[1:2]), (2, [DAYS[0], DAYS[2]])]


def test_a_batch_with_a_record_is_not_loaded_again(spark, tmp_path):
    lake, calls = jobs.Lake(str(tmp_path)), []
    put(tmp_path, DAYS[0], "007", 1)

    def ingest(*a):
        calls.append(a[2])
        return jobs.ingest(*a)

    batch = spark.createDataFrame([(f"file:{tmp_path}/raw/dt={DAYS[0]}/vehicle_id=007.csv", 10)], "path string, length long")
    for _ in range(2):
        loads.load_batch(spark, lake, batch, 7, "x", QUICK, ingest)
    loads.load_batch(spark, lake, batch.limit(0), 8, "x", QUICK, ingest)
    assert calls == [DAYS[:1]]
    assert loads.load_records(spark, lake, "x").first().raw_rows > 0
