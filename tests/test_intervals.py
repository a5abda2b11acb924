"""Sets of active codes and tiles of long events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.operators import intervals
from wattline.operators.series import Series

START = datetime(2026, 1, 1)


def at(s):
    return None if s is None else START + timedelta(seconds=s)


@pytest.fixture(scope="module")
def log():
    rng = random.Random(9)
    faults = []
    for _ in range(400):
        a = rng.randrange(1000)
        faults.append((rng.choice("xyz"), rng.choice(["p", "q", "r", "s" * 3]), a, rng.choice([None, a, a + rng.randrange(60), a + 5, a - 3])))
    faults += [("x", None, 5, 9), ("x", "p", None, 9), ("w", "only", 3, 3), (None, "p", 1, 900), *faults[:20]]
    rows = [(rng.choice(["x", "y", "z", "w", "v", None]), rng.randrange(1100), i) for i in range(900)]
    rows += [("x", None, 900), ("w", 3, 901), ("w", 4, 902), ("w", 2, 903)]
    return faults, rows


def frames(spark, log):
    faults, rows = log
    f = spark.createDataFrame([(k, c, at(a), at(b)) for k, c, a, b in faults], "k string, code string, activated_at timestamp, fixed_at timestamp")
    return f, spark.createDataFrame([(k, at(t), i) for k, t, i in rows], "k string, t timestamp, i int")


def active(faults, key, t):
    if t is None:
        return []
    return sorted({c for k, c, a, b in faults if k == key and c is not None and a is not None and a <= t and (b is None or a <= b and t <= b)})


@pytest.mark.parametrize("most", [4_000_000, 60])
def test_open_codes_equal_all_pairs(spark, log, most):
    faults, df = frames(spark, log)
    got = intervals.open_codes(df, faults, Series("k", "t", "i", max_rows=most))
    assert got.columns == [*df.columns, "open_codes"]
    assert {r.i: r.open_codes for r in got.collect()} == {i: active(log[0], k, t) for k, t, i in log[1]}


def test_flags_of_the_codes_asked_for(spark, log):
    faults, df = frames(spark, log)
    got = intervals.interval_flags(df, faults, Series("k", "t", "i"), ["p", "never"]).collect()
    assert {r.i: (r.fault_p, r.fault_never, r.fault_any) for r in got} == {
        i: (int("p" in active(log[0], k, t)), 0, int("p" in active(log[0], k, t))) for k, t, i in log[1]
    }


def test_merged_intervals_do_not_touch(spark, log):
    rows = intervals.merged_intervals(frames(spark, log)[0], ["k"]).orderBy("k", "code", "_from").collect()
    for a, b in zip(rows, rows[1:]):
        if (a.k, a.code) == (b.k, b.code):
            assert a._till is not None and a._till < b._from


def test_no_intervals(spark, log):
    faults, df = frames(spark, log)
    assert {tuple(r.open_codes) for r in intervals.open_codes(df, faults.limit(0), Series("k", "t", "i")).collect()} == {()}
    assert intervals.open_codes(df.limit(0), faults, Series("k", "t", "i")).collect() == []


def test_plan_is_as_wide_for_many_codes(spark, log):
    _, df = frames(spark, log)
    many = spark.range(5000).select(F.lit("x").alias("k"), F.concat(F.lit("c"), "id").alias("code"), F.lit(at(3)).alias("activated_at"), F.lit(at(50)).alias("fixed_at"))
    got = intervals.open_codes(df, many, Series("k", "t", "i"))
    assert len(got._jdf.queryExecution().analyzed().toString()) < 60_000
    assert {r.i: len(r.open_codes) for r in got.collect()} == {i: 5000 * (k == "x" and t is not None and 3 <= t <= 50) for k, t, i in log[1]}


@pytest.mark.parametrize("first, last", [(0, 0), (0, 1), (1, 2), (5, 5), (3, 1000), (-7, 9), (-1000, -1), (1 << 30, (1 << 30) + 12345), (-5, 1 << 40)])
def test_tiles_cover_a_range_once(spark, first, last):
    df = spark.createDataFrame([(first, last)], "a long, b long")
    found = [(r.level, r.tile) for r in df.select(F.inline(intervals.tiles(F.col("a"), F.col("b")))).collect()]
    spans = sorted((t << n, (t + 1 << n) - 1) for n, t in found)
    assert spans[0][0] == first and spans[-1][1] == last
    assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert len(found) <= 2 * max(1, (last - first + 1).bit_length())


def test_segments_equal_all_pairs(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), rng.randrange(-50_000, 200_000), i) for i in range(500)]
    events = [(rng.choice("xyw"), i, (a := rng.randrange(100_000)), a + rng.choice([0, 10, 900, 10**4, 10**9, -5])) for i in range(60)]
    events += [("x", 90, None, 5), ("x", 91, 5, None)]
    df = spark.createDataFrame([(k, at(t), i) for k, t, i in rows], "k string, t timestamp, i int")
    log = spark.createDataFrame([(k, e, at(a), at(b)) for k, e, a, b in events], "k string, e int, a timestamp, b timestamp")
    for bucket in (1, 600, 10**7):
        got = intervals.event_segments(df, log, Series("k", "t", "i"), "e", "a", "b", 100, 50, bucket)
        want = sorted((i, e) for k, t, i in rows for q, e, a, b in events if k == q and a is not None and b is not None and a - 100 <= b + 50 and a - 100 <= t <= b + 50)
        assert sorted((r.i, r.segment_event) for r in got.collect()) == want
    assert intervals.event_segments(df, log.limit(0), Series("k", "t", "i"), "e", "a", "b").collect() == []


def test_no_tiles_go_through_the_driver(spark):
    df = spark.createDataFrame([("x", START, 1), ("x", at(60), 2), ("y", at(5), 3)], "k string, t timestamp, i int")
    events = spark.createDataFrame([("x", 7, START, at(10**8)), ("y", 8, at(6), at(9))], "k string, n long, a timestamp, b timestamp")
    got = intervals.event_segments(df, events, Series("k", "t", "i"), "n", "a", "b", before_s=0, after_s=0)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.i, r.segment_event) for r in got.collect()) == [(1, 7), (2, 7)]
