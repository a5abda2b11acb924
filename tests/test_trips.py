"""Trips against a row-by-row model of the rule, over files, with state."""

import random

import pytest
from pyspark.sql import functions as F

from wattline.config import GAP_INSERTED, TripConfig
from wattline.operators import sessions
from wattline.operators.series import Series

SCHEMA = "dt string, vehicle_id string, s long, quality_flag int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("timestamp", F.timestamp_seconds("s"))


def real(df):
    """Trip state needs the real rows only."""
    return df.where(F.col("quality_flag") == 0).select("dt", "vehicle_id", "timestamp")


def walk(files, gap_break, min_rows, seq=0, open_id=None):
    """Trip number per row of one vehicle's files, row by row."""
    out = {}
    for day, rows in files:
        number = {}
        i = 0
        while i < len(rows):
            j = i
            while j < len(rows) and (rows[j][1] == 0) == (rows[i][1] == 0):
                j += 1
            run = [s for s, _ in rows[i:j]]
            if rows[i][1] == 0:
                if open_id is None:
                    seq += 1
                    open_id = seq
                number.update({s: open_id for s in run})
            elif open_id is not None:
                if len(run) < gap_break:
                    number.update({s: open_id for s in run})
                else:
                    number.update({s: open_id for s in run[: gap_break - 1]})
                    open_id = None
            i = j
        for n in set(number.values()):
            if sum(v == n for v in number.values()) < min_rows:
                number = {s: v for s, v in number.items() if v != n}
                if open_id == n:
                    open_id = None
        out[day] = number
    return out, seq, open_id


def random_files(rng, days):
    files, at = [], 0
    for d in range(days):
        at += rng.choice([1, 5, 40])
        rows = []
        for _ in range(rng.randint(1, 6)):
            rows += [0] * rng.randint(1, 12) + [GAP_INSERTED] * rng.choice([1, 2, 4, 5, 6, 9])
        while rows[-1]:
            rows.pop()
        files.append((f"2026-01-{d + 1:02d}", [(at + i, f) for i, f in enumerate(rows)]))
        at += len(rows)
    return files


@pytest.mark.parametrize("max_rows", [4_000_000, 9])
def test_trips_follow_the_rule_over_files(spark, max_rows):
    rng = random.Random(11)
    vehicles = {f"V{v}": random_files(rng, 5) for v in range(25)}
    config = TripConfig(gap_break=5, min_rows=6)
    rows = [(day, v, s, f) for v, files in vehicles.items() for day, r in files for s, f in r]
    series = Series(("dt", "vehicle_id"), "timestamp", max_rows=max_rows)
    got = sessions.trips(frame(spark, rows), config=config, series=series).collect()
    state = {r["vehicle_id"]: r for r in sessions.trip_state(real(frame(spark, rows)), config=config, series=series).collect()}
    found = {(r["dt"], r["vehicle_id"], r["s"]): r["trip_id"] for r in got}
    for v, files in vehicles.items():
        want, seq, open_id = walk(files, 5, 6)
        for day, r in files:
            for s, _ in r:
                n = want[day].get(s)
                assert found[day, v, s] == (f"{v}_{n:06d}" if n else None), (v, day, s)
        assert state[v]["trip_seq"] == seq
        assert state[v]["open_trip_id"] == (f"{v}_{open_id:06d}" if open_id else None)


def test_state_carries_over_runs_and_reruns_agree(spark):
    rng = random.Random(3)
    vehicles = {f"V{v}": random_files(rng, 4) for v in range(12)}
    config = TripConfig(gap_break=5, min_rows=6)
    rows = [(day, v, s, f) for v, files in vehicles.items() for day, r in files for s, f in r]
    whole = {(r["dt"], r["vehicle_id"], r["s"]): r["trip_id"] for r in sessions.trips(frame(spark, rows), config=config).collect()}
    first = frame(spark, [r for r in rows if r[0] <= "2026-01-02"])
    rest = frame(spark, [r for r in rows if r[0] > "2026-01-02"])
    state = sessions.trip_state(real(first), config=config)
    for _ in range(2):
        parts = sessions.trips(first, config=config).unionByName(sessions.trips(rest, config=config, state=state))
        assert {(r["dt"], r["vehicle_id"], r["s"]): r["trip_id"] for r in parts.collect()} == whole
    end_whole = {tuple(r) for r in sessions.trip_state(real(frame(spark, rows)), config=config).collect()}
    end_parts = {tuple(r) for r in sessions.trip_state(real(rest), config=config, state=state).collect()}
    assert end_whole == end_parts


def test_golden_gaps(spark):
    def one(gap):
        rows = [("d", "v", s, 0) for s in range(60)]
        rows += [("d", "v", 60 + s, GAP_INSERTED) for s in range(gap)]
        rows += [("d", "v", 60 + gap + s, 0) for s in range(60)]
        return [r["trip_id"] for r in sessions.trips(frame(spark, rows)).orderBy("s").collect()]

    assert set(one(299)) == {"v_000001"}
    ids = one(300)
    assert ids.count("v_000001") == 60 + 299 and ids.count(None) == 1 and ids.count("v_000002") == 60


def test_padding_and_file_gap_options(spark):
    rows = [("d1", "v", 0, 0)] + [("d1", "v", 1 + s, GAP_INSERTED) for s in range(400)] + [("d1", "v", 401 + s, 0) for s in range(70)]
    rows += [("d2", "v", 100_000 + s, 0) for s in range(70)]
    df = frame(spark, rows)
    ids = {r["s"]: r["trip_id"] for r in sessions.trips(df).collect()}
    assert ids[0] == "v_000001" and ids[401] == ids[100_000] == "v_000002"
    real = {r["s"]: r["trip_id"] for r in sessions.trips(df, count_padding=False).collect()}
    assert real[0] is None and real[10] is None and real[401] == "v_000002"
    apart = {r["s"]: r["trip_id"] for r in sessions.trips(df, check_file_gap=True).collect()}
    assert apart[401] == "v_000002" and apart[100_000] == "v_000003"


def test_spans_break_after_the_gap(spark):
    df = spark.createDataFrame([("v", t) for t in (0, 10, 20, 31, 32)], "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    out = sessions.spans(df, Series("k", "ts"), 10).orderBy("span").collect()
    assert [r["rows"] for r in out] == [3, 2]


def walked_with_gaps(rng, days):
    """Files whose first and last rows may be gap rows."""
    files, at = [], 0
    for d in range(days):
        at += rng.choice([1, 40])
        rows = [GAP_INSERTED] * rng.choice([0, 0, 2, 4, 7])
        for _ in range(rng.randint(1, 4)):
            rows += [0] * rng.randint(8, 14) + [GAP_INSERTED] * rng.choice([1, 4, 5, 9])
        files.append((f"2026-01-{d + 1:02d}", [(at + i, f) for i, f in enumerate(rows)]))
        at += len(rows)
    return files


def test_gap_rows_at_the_ends_of_files(spark):
    rng = random.Random(23)
    vehicles = {f"V{v}": walked_with_gaps(rng, 4) for v in range(25)}
    config = TripConfig(gap_break=5, min_rows=6)
    rows = [(day, v, s, f) for v, files in vehicles.items() for day, r in files for s, f in r]
    df = frame(spark, rows)
    bounds = df.groupBy("dt", "vehicle_id").agg((F.min("s") * 1_000_000).alias("_lo"), (F.max("s") * 1_000_000).alias("_hi"))
    found = {(r["dt"], r["vehicle_id"], r["s"]): r["trip_id"] for r in sessions.trips(df, config=config).collect()}
    days = sorted({r[0] for r in rows})
    states = {(r["as_of"], r["vehicle_id"]): r for r in sessions.trip_states(real(df), days, config=config, bounds=bounds).collect()}
    for v, files in vehicles.items():
        for upto in range(1, len(files) + 1):
            want, seq, open_id = walk(files[:upto], 5, 6)
            state = states[files[upto - 1][0], v]
            assert (state["trip_seq"], state["open_trip_id"]) == (seq, f"{v}_{open_id:06d}" if open_id else None)
        for day, r in files:
            for s, _ in r:
                n = want[day].get(s)
                assert found[day, v, s] == (f"{v}_{n:06d}" if n else None), (v, day, s)


def test_any_day_can_be_run_again(spark):
    rng = random.Random(8)
    vehicles = {f"V{v}": random_files(rng, 4) for v in range(8)}
    config = TripConfig(gap_break=5, min_rows=6)
    rows = [(day, v, s, f) for v, files in vehicles.items() for day, r in files for s, f in r if (day, v) != ("2026-01-02", "V0")]
    whole = {(r["dt"], r["vehicle_id"], r["s"]): r["trip_id"] for r in sessions.trips(frame(spark, rows), config=config).collect()}
    days = sorted({r[0] for r in rows})
    states = sessions.trip_states(real(frame(spark, rows)), days, config=config).cache()
    assert states.where("vehicle_id = 'V0'").count() == len(days)  # also of the day without a file
    for before, day in zip(days, days[1:]):
        one = frame(spark, [r for r in rows if r[0] == day])
        state = states.where(F.col("as_of") == before).drop("as_of")
        for r in sessions.trips(one, config=config, state=state).collect():
            assert whole[r["dt"], r["vehicle_id"], r["s"]] == r["trip_id"]
