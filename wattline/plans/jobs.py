"""The batch jobs: ingest raw files, build features, train, evaluate and watch drift.

Each job is one plan per written table over all vehicles and days asked for; there is no loop over
files. A table that several later plans read is written once and read back.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import scalar as S
from wattline.operators import aggregates as A
from wattline.operators import boosting, clean, datasets, diagnostics, drift, evaluation, intervals, model, resample, sessions, windows
from wattline.operators.series import Series, measure
from wattline.session import stored
from wattline.sources import tables as IO

KEYS = ("dt", "vehicle_id")
FILE = Series(KEYS, "timestamp")


@dataclass(frozen=True)
class Lake:
    """Where the tables live."""

    root: str
    raw: str = ""
    raw_faults: str = ""

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def raw_files(self) -> str:
        return self.raw or self.at("raw")

    @property
    def fault_files(self) -> str:
        return self.raw_faults or self.at("raw_faults")


@dataclass(frozen=True)
class Settings:
    resample: C.ResampleConfig = field(default_factory=C.ResampleConfig)
    trips: C.TripConfig = field(default_factory=C.TripConfig)
    gold: C.GoldConfig = field(default_factory=C.GoldConfig)
    forecast: C.ForecastConfig = field(default_factory=C.ForecastConfig)
    time_formats: Sequence[str] = C.TIME_FORMATS


# ---- raw files to the gridded series


def ingest(spark: SparkSession, lake: Lake, days: Sequence[str], settings: Settings = Settings()) -> DataFrame:
    """Raw files of the given days to validated and gridded tables; returns the manifest.

    The trip state is kept after each day, so any day can be run again by itself.
    """
    days = sorted(days)
    raw = clean.standardize(IO.read_raw(spark, lake.raw_files, days))
    checked = clean.flagged(clean.parsed(raw, time_formats=settings.time_formats))
    checked = rewritten(spark, checked, lake.at("staging/checked"), days)  # text is parsed once
    IO.write_json(clean.validation_report(checked), lake.at(f"reports/validation/{days[0]}_{days[-1]}"))

    valid = S.check_ranges(checked.where(F.col("timestamp").isNotNull()), C.RANGES).drop("_reversed")
    valid = rewritten(spark, valid, lake.at("raw_parquet"), days)

    faults = intervals.clean_faults(IO.read_faults(spark, lake.fault_files, days, settings.time_formats))
    silver, series = gridded(valid, faults, settings)
    state = trip_state_before(spark, lake, days[0])
    step = settings.resample.step_s
    real = resample.real_ticks(valid, KEYS, step_s=step)
    bounds = resample.grid_bounds(valid, KEYS, step_s=step)
    options = {"step_s": step, "config": settings.trips, "state": state, "series": series, "bounds": bounds}
    with_trips = sessions.trips(silver, real=real, **options)
    written = rewritten(spark, with_trips, lake.at("silver"), days)
    after = sessions.trip_states(real, days, **options)
    after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(lake.at("state/trips"))

    manifest = A.ingest_manifest(valid, written, faults)
    IO.write_json(manifest, lake.at(f"reports/ingest/{days[0]}_{days[-1]}"))
    return manifest


def rewritten(spark: SparkSession, df: DataFrame, path: str, days: Sequence[str]) -> DataFrame:
    """The days of a table, replaced by df and read back with its columns; df may have no rows."""
    IO.write_table(df, path, days)
    return IO.read_table(spark, path, days, schema=df.schema)


def gridded(valid: DataFrame, faults: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Series]:
    """Validated rows on the regular grid with fault flags; and how long the files' grids are."""
    order = [c for c in clean.FILE_ORDER if c in valid.columns]
    grid = resample.resample(valid, KEYS, config=settings.resample, order=order)
    codes = intervals.fault_codes(faults)
    series = measure(valid, FILE, step=settings.resample.step_s * 1_000_000)
    flagged = intervals.interval_flags(grid, faults, series, codes)
    return flagged, series


def trip_state_before(spark: SparkSession, lake: Lake, day: str) -> DataFrame | None:
    """The newest trip state from before a day, or None."""
    saved = [f.split("=", 1)[1] for f in IO.folders(spark, lake.at("state/trips")) if f.startswith("as_of=")]
    earlier = [d for d in saved if d < day]
    if not earlier:
        return None
    return spark.read.parquet(lake.at(f"state/trips/as_of={max(earlier)}"))


# ---- features


def gold(spark: SparkSession, lake: Lake, days: Sequence[str], settings: Settings = Settings(), wanted: Sequence[str] | None = None) -> DataFrame:
    """Feature rows, trip rows and daily rows of the given days; returns the daily rows.

    `wanted` limits the window columns to those a task needs.
    """
    g = settings.gold
    days = sorted(days)
    silver = IO.read_table(spark, lake.at("silver"), days)
    rows = rewritten(spark, feature_rows(silver, g, wanted), lake.at("gold/window_features"), days)
    trip_rows = rewritten(spark, trip_table(rows, g), lake.at("gold/trip_features"), days)
    daily = A.daily_rows(silver, rows, trip_rows, g.drop_mask, g.daily_min_rows)
    daily = rewritten(spark, daily, lake.at("gold/daily_stats"), days)
    IO.write_json(A.gold_totals(daily), lake.at(f"reports/gold/{days[0]}_{days[-1]}"))
    return daily


def feature_rows(silver: DataFrame, g: C.GoldConfig = C.GoldConfig(), wanted: Sequence[str] | None = None) -> DataFrame:
    """Quality filter, window columns, physics and label; the scan reads only the columns used."""
    df = S.existing(silver, [*KEYS, "timestamp", "trip_id", "quality_flag", "fault_any", *g.signals])
    S.require(df, [*KEYS, "timestamp", "trip_id", "quality_flag", g.target_source], "silver")
    df = S.add_missing(df, ["fault_any"], 0, "int")
    df = df.withColumns(
        {
            "quality_flag": F.coalesce(F.col("quality_flag"), F.lit(0)),
            "fault_any": F.coalesce(F.col("fault_any"), F.lit(0)),
        }
    )
    df = S.without_bits(df, "quality_flag", g.drop_mask).where(F.col("trip_id").isNotNull())
    series = Series((*KEYS, "trip_id"), "timestamp")
    df = windows.window_features(
        df, series, g.signals, g.windows, g.aggs, g.lags, g.target_source, g.horizon, g.target, wanted
    )
    df = S.physics(df).where(windows.plausible(g.target_source, g.target, g.max_jump))
    first = ["timestamp", "vehicle_id", "trip_id", "quality_flag", "fault_any", g.target_source, g.target, "label_available"]
    return S.ordered_columns(df, first)


def trip_table(rows: DataFrame, g: C.GoldConfig = C.GoldConfig(), across_days: bool = False) -> DataFrame:
    """Trip rows per file, or over all files a trip spans."""
    keys = ("vehicle_id", "trip_id") if across_days else (*KEYS, "trip_id")
    have = set(rows.columns)
    return A.trip_rows(
        rows,
        keys,
        "timestamp",
        level="soc_pct",
        fault="fault_any",
        peaks=[c for c in ("motor_temperature_c", "max_battery_temp_c", "battery_temp_delta_c") if c in have],
        power="output_power_kw" if "output_power_kw" in have else None,
        min_rows=g.trip_min_rows,
    )


# ---- model


def day_range(first: str, last: str) -> list[str]:
    """All days from `first` to `last`, both included: a backfill is one job over such a list."""
    a, b = date.fromisoformat(first), date.fromisoformat(last)
    if b < a:
        raise ValueError(f"{last} is before {first}")
    return [str(a + timedelta(n)) for n in range((b - a).days + 1)]


def load_training(spark: SparkSession, lake: Lake, days: Sequence[str], vehicles: Sequence[str] | None, f: C.ForecastConfig) -> DataFrame:
    """Training rows of the days and vehicles; files that are absent are named in a warning."""
    rows = IO.read_table(spark, lake.at("gold/window_features"), list(days), vehicles)
    if vehicles is not None:
        absent = IO.missing_files(rows, days, vehicles).orderBy("dt", "vehicle_id").limit(20).collect()
        if absent:
            warnings.warn(f"no feature rows for {[tuple(r) for r in absent]}" + " and maybe others" * (len(absent) == 20))
    return datasets.training_rows(rows, f.features, f.target, f.drop_mask)


def micro_filtered(df: DataFrame, f: C.ForecastConfig) -> DataFrame:
    return A.filter_micro_trips(df, ["trip_id"], "soc_pct", f.micro_min_rows, f.micro_min_range)


def train(
    spark: SparkSession,
    lake: Lake,
    train_days: Sequence[str],
    val_days: Sequence[str],
    vehicles: Sequence[str] | None = None,
    settings: Settings = Settings(),
) -> str:
    """Fit, evaluate and save a new run; returns its folder."""
    f = settings.forecast
    fit_rows = load_training(spark, lake, train_days, vehicles, f)
    val_rows = micro_filtered(load_training(spark, lake, val_days, vehicles, f), f)
    for name, rows in (("training", fit_rows), ("validation", val_rows)):
        if rows.isEmpty():
            raise ValueError(f"no {name} rows are left after filtering")
    fitted = boosting.fit(fit_rows, val_rows, f)

    scored = model.predict(fitted, fit_rows, f.target).withColumn("split", F.lit("train"))
    scored = scored.unionByName(
        model.predict(fitted, val_rows, f.target).withColumn("split", F.lit("val")), allowMissingColumns=True
    )
    scored = stored(scored, "scored")  # each report reads what it needs; no row is scored twice
    reports = evaluation_tables(scored, f, fitted, spark)
    counts = {
        r["split"]: r
        for r in datasets.split_summary(scored.select("split", "trip_id", "timestamp")).collect()  # two rows
    }
    stamp = {"train_days": list(train_days), "val_days": list(val_days)}
    for side in ("train", "val"):
        stamp[f"{side}_rows"] = counts[side]["rows"] if side in counts else 0
        stamp[f"{side}_trips"] = counts[side]["trips"] if side in counts else 0
    root = lake.at("models")
    run_id = model.next_run_id(spark, root, f.task, max(train_days))
    hashes = IO.fingerprints(spark, lake.at("gold/window_features"), [*train_days, *val_days], vehicles)
    return model.save_run(
        spark, root, run_id, fitted, f, stamp, hashes, reports, drift.baseline(fit_rows, f.features)
    )


def evaluation_tables(scored: DataFrame, f: C.ForecastConfig, fitted=None, spark=None) -> dict[str, DataFrame]:
    """The evaluation as small tables; `scored` has both sides in `split`."""
    y, val = f.target, scored.where(F.col("split") == "val")
    S.require(val, ["trip_id", "soc_pct", "soc_pct_roll_mean_60s"], "validation rows")
    worst = [
        "timestamp", "trip_id", "soc_pct", y, "pred", "error", "abs_error", "battery_current_a", "output_power_kw", "fault_any"
    ]
    out = {
        "summary": evaluation.train_val_metrics(scored, y, "pred", t=f.thresholds),
        "baselines": evaluation.baseline_maes(val, y, "soc_pct", "soc_pct_roll_mean_60s"),
        "per_trip": evaluation.regression_metrics(val, y, "pred", ["trip_id"]),
        "buckets": evaluation.bucket_metrics(val, y, "pred", "soc_pct"),
        "error_distribution": evaluation.error_distribution(val),
        "slices": evaluation.slice_metrics(val, y, "pred", "soc_pct"),
        "worst": evaluation.worst_rows(S.existing(val, worst), 10, ties=["timestamp", "trip_id"]),
    }
    if fitted is not None:
        out["importance"] = boosting.importance(fitted, spark)
    return out


def evaluate(
    spark: SparkSession,
    lake: Lake,
    day: str,
    vehicles: Sequence[str] | None = None,
    run_id: str | None = None,
    settings: Settings = Settings(),
    reference_days: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Score a saved run on a new day, with the drift check, and write both reports."""
    run = model.load_run(spark, lake.at("models"), settings.forecast.task, run_id)
    f = replace(settings.forecast, features=tuple(run.features), target=run.target)
    rows = micro_filtered(load_training(spark, lake, [day], vehicles, f), f)
    if rows.isEmpty():
        raise ValueError(f"no rows of {day} are left after filtering")
    scored = stored(model.predict(run.model, rows, f.target).withColumn("split", F.lit("val")), "scored")
    out = evaluation_tables(scored, f)
    report = _drift(spark, lake, run, rows, f, vehicles, reference_days)
    out["drift"] = report
    out["drift_summary"] = drift.drift_summary(report)
    for name, table in out.items():
        IO.write_json(table, lake.at(f"drift_reports/dt={day}_eval/{name}"))
    return out


def check_drift(
    spark: SparkSession,
    lake: Lake,
    day: str,
    vehicles: Sequence[str] | None = None,
    run_id: str | None = None,
    settings: Settings = Settings(),
    reference_days: Sequence[str] | None = None,
) -> DataFrame:
    """Drift of one day against a saved run. NULL rates are taken before rows with NULLs are dropped."""
    run = model.load_run(spark, lake.at("models"), settings.forecast.task, run_id)
    f = replace(settings.forecast, features=tuple(run.features), target=run.target)
    rows = IO.read_table(spark, lake.at("gold/window_features"), [day], vehicles)
    rows = datasets.training_rows(rows, f.features, f.target, f.drop_mask, drop_nulls=False)
    report = _drift(spark, lake, run, rows, f, vehicles, reference_days)
    IO.write_json(report, lake.at(f"drift_reports/dt={day}/features"))
    IO.write_json(drift.drift_summary(report), lake.at(f"drift_reports/dt={day}/summary"))
    return report


def _drift(spark, lake, run, rows, f, vehicles, reference_days) -> DataFrame:
    """Against the training rows themselves where their days are given, else against the saved sketch."""
    sample = None
    if reference_days:
        sample = load_training(spark, lake, reference_days, vehicles, f).select(*f.features)
    base = model.run_baseline(spark, run)
    return drift.drift_report(base, rows.select(*f.features), sample, f.thresholds)


# ---- one day in depth


def study(
    spark: SparkSession,
    lake: Lake,
    day: str,
    vehicles: Sequence[str] | None = None,
    n_val: int = 20,
    settings: Settings = Settings(),
) -> dict[str, DataFrame]:
    """Hold out the last trips of one day, fit on the rest, and write what there is to see as CSV: constant
    features, baselines, scored rows, errors per trip, importances and suspicious rows."""
    f = replace(settings.forecast, drop_mask=C.GAP_INSERTED)
    rows = load_training(spark, lake, [day], vehicles, f)
    names = {"speed": "motor_speed_rpm", "power": "output_power_kw", "current": "battery_current_a"}
    rows = diagnostics.quiet_rows(rows, "soc_pct", f.target, **names)
    split = datasets.split_last_trips(rows, n_val)
    fit_rows, val_rows = (split.where(F.col("split") == s) for s in ("train", "val"))
    fitted = boosting.fit(fit_rows, val_rows, f)

    scored = stored(model.predict(fitted, split, f.target), "scored")
    val = scored.where(F.col("split") == "val")
    shown = [
        "timestamp", "trip_id", "soc_pct", f.target, "battery_current_a", "output_power_kw", "motor_speed_rpm",
        "quality_flag", "pred", "error", "abs_error",
    ]
    ties = ["timestamp", "trip_id"]
    rolled = "soc_pct_roll_mean_60s"
    out = {
        "feature_constant_report": A.constant_report(rows, f.features),
        "split_summary": datasets.split_summary(split),
        "baselines": evaluation.baseline_maes(val, f.target, "soc_pct", rolled if rolled in val.columns else None),
        "summary": evaluation.train_val_metrics(scored, f.target, "pred", t=f.thresholds),
        "val_predictions": S.existing(val, shown),
        "val_per_trip": evaluation.trip_summary(val, "trip_id", "soc_pct"),
        "feature_importance": boosting.importance(fitted, spark, None),
        "worst_rows": evaluation.worst_rows(S.existing(val, shown), 15, ties=ties),
        "suspicious_rows": S.existing(diagnostics.contradictions(val), shown),
        "level_jumps": S.existing(diagnostics.level_jumps(val, "soc_pct", f.target), [*shown, "level_change"]),
        "tail_shares": evaluation.tail_shares(val),
        "error_histogram": evaluation.histogram(val, "abs_error", 60),
    }
    for name, table in out.items():
        IO.write_csv(table, lake.at(f"reports/study/dt={day}/{name}"))
    return out
