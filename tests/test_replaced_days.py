"""A day is the old or the new one at every moment, also when a writer stops between its two moves."""

import pytest

from wattline.sources import tables as IO

ROWS = "dt string, vehicle_id string, v long"


def rows(spark, v, days=("d1", "d2")):
    return spark.createDataFrame([(d, k, v) for d in days for k in ("007", "b")], ROWS)


def read(spark, root, **which):
    spark.catalog.clearCache()
    return sorted((r.dt, r.vehicle_id, r.v) for r in IO.read_table(spark, root, **which).collect())


def whole(v, days=("d1", "d2")):
    return sorted((d, k, v) for d in days for k in ("007", "b"))


@pytest.mark.parametrize("stop_at", [1, 2, 3, 4])
def test_a_writer_that_stops(spark, folder, monkeypatch, stop_at):
    root = f"{folder}/t"
    IO.write_table(rows(spark, 1), root, ["d1", "d2"])
    assert read(spark, root) == whole(1)
    real, calls = IO.rename, []

    def stops(*a):
        calls.append(a)
        if len(calls) == stop_at:
            raise OSError("stopped")
        real(*a)

    monkeypatch.setattr(IO, "rename", stops)
    with pytest.raises(OSError, match="stopped"):
        IO.write_table(rows(spark, 2), root, ["d1", "d2"])
    monkeypatch.setattr(IO, "rename", real)
    for which in ({}, {"days": ["d1", "d2"]}, {"first_day": "d1"}):
        got = read(spark, root, **which)
        assert [r[:2] for r in got] == [r[:2] for r in whole(1)]
        assert all(len({v for d, _, v in got if d == day}) == 1 for day in ("d1", "d2"))
    assert dict(IO.read_table(spark, root).dtypes)["vehicle_id"] == "string"
    IO.write_table(rows(spark, 3, ["d1"]), root, ["d1", "d2"])  # afterwards the second day has no rows
    assert read(spark, root) == whole(3, ["d1"])
    IO.write_table(rows(spark, 4), root, ["d1", "d2"])
    assert read(spark, root) == whole(4)


def test_other_days_stay(spark, folder):
    root = f"{folder}/t"
    IO.write_table(rows(spark, 1), root, ["d1", "d2"])
    IO.write_table(rows(spark, 2, ["d2"]), root, ["d2"])
    assert read(spark, root) == sorted(whole(1, ["d1"]) + whole(2, ["d2"]))
    assert set(IO.day_folders(spark, root).values()) == {root}
    assert IO.day_folders(spark, f"{folder}/none") == {}


@pytest.mark.parametrize("guess", ["true", "false"])
def test_vehicles_are_text_in_any_session(spark, folder, guess):
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    root, before = f"{folder}/t", spark.conf.get(name)
    made = spark.createDataFrame([("2026-01-02", v, 1) for v in ("007", "1.0", "7")], ROWS)
    IO.write_table(made, root, ["2026-01-02"])
    spark.conf.set(name, guess)
    try:
        got = IO.read_table(spark, root)
        assert dict(got.dtypes) == {"dt": "string", "vehicle_id": "string", "v": "bigint"}
        assert sorted(map(tuple, got.select("dt", "vehicle_id").collect())) == [("2026-01-02", v) for v in ("007", "1.0", "7")]
        assert [r.v for r in IO.read_table(spark, root, vehicles=["007"]).collect()] == [1]
    finally:
        spark.conf.set(name, before)
