"""Every operator as a query over the driver's tables.

The series are the users of `events`; `error` events play the faults. `lineitem` columns stand in for
signals, labels and predictions, customers' orders for trips. Each query reads its whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import config as C
from wattline.functions import scalar as S
from wattline.operators import aggregates as A
from wattline.operators import boosting, clean, datasets, diagnostics, drift, evaluation, intervals, model, summaries
from wattline.operators import quantiles as Q
from wattline.operators import resample as R
from wattline.operators import sessions as T
from wattline.operators import windows as W
from wattline.operators.series import Series, measure
from wattline.plans import jobs
from wattline.session import checkpoint_dir, stored
from wattline.sources import tables as IO
from wattline.streaming import loads
from wattline.streaming import stream as streams
from wattline.streaming import trips as state_trips

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOUR = 3600
USER = Series("user_id", "ts", "event_id")
FILE = Series(("dt", "vehicle_id"), "timestamp")
HOURLY = C.ResampleConfig(step_s=HOUR, fast_limit_s=5 * HOUR, slow_limit_s=24 * HOUR, status_limit_s=48 * HOUR)
DAILY_TRIPS = C.TripConfig(gap_break=4, min_rows=2)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables' times carry no zone
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(
        *[
            F.round(F.col(n), digits).alias(n) if t in ("double", "float") and n not in skip else F.col(n)
            for n, t in df.dtypes
        ]
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a reading that is missing on sign-ups and a quality mask."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        "value",
        F.when(kind != "signup", F.col("value")).alias("reading"),
        F.when(kind == "error", C.HARD_RANGE_BREACH).when(kind == "view", C.SOFT_RANGE_BREACH).otherwise(0).alias("quality_flag"),
        F.when(kind == "error", 1).otherwise(0).alias("fault_any"),
    )


# ---- sessions


def user_sessions(spark, sf, min_rows=2) -> DataFrame:
    return T.sessions(events(spark, sf), USER, gap_break=4 * HOUR, min_rows=min_rows)


@query
def sessions(spark, sf):
    return user_sessions(spark, sf).select("event_id", "user_id", "trip_id")


@query
def session_summary(spark, sf):
    rows = user_sessions(spark, sf).where(F.col("trip_id").isNotNull())
    out = A.trip_rows(
        rows, ["user_id", "trip_id"], "ts", level="reading", fault="fault_any", peaks=["value"],
        power="reading", min_rows=3, ties=["event_id"],
    )
    return rounded(out)


@query
def session_totals(spark, sf):
    """Exact distinct counts per user (trips and values)."""
    return user_sessions(spark, sf).groupBy("user_id").agg(
        F.count_distinct("trip_id").alias("trips"), F.count_distinct("value").alias("values")
    )


def daily_events(spark, sf) -> DataFrame:
    """Events as files: one per user and day."""
    return events(spark, sf).select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.col("ts").alias("timestamp"),
        "reading",
        "quality_flag",
        F.col("fault_any").cast("double").alias("fault_share"),
    )


def daily_ticks(spark, sf) -> tuple[DataFrame, Series]:
    """The hours with events, per file, and how long the files will be on the grid."""
    e = daily_events(spark, sf)
    return R.real_ticks(e, FILE.keys, step_s=HOUR, align="floor"), measure(e, FILE, step=HOUR * 1_000_000)


def daily_trips(spark, sf) -> DataFrame:
    real, series = daily_ticks(spark, sf)
    bounds = R.grid_bounds(daily_events(spark, sf), FILE.keys, step_s=HOUR, align="floor")
    grid = R.resample(
        daily_events(spark, sf), FILE.keys, config=HOURLY, fast=[], slow=["reading"], status=[], counter=[], align="floor"
    )
    return T.trips(grid, step_s=HOUR, config=DAILY_TRIPS, series=series, real=real, bounds=bounds)


def silver(spark, sf) -> DataFrame:
    """Written out once, as the jobs do, for plans that read it several times."""
    checkpoint_dir(spark)
    return daily_trips(spark, sf).checkpoint()


@query
def trips_across_files(spark, sf):
    """Trip numbers that run on from file to file."""
    return daily_trips(spark, sf).select("dt", "vehicle_id", "timestamp", "trip_id")


@query
def trip_state(spark, sf):
    real, series = daily_ticks(spark, sf)
    out = T.trip_state(real, step_s=HOUR, config=DAILY_TRIPS, series=series)
    return out.select(
        "vehicle_id",
        "trip_seq",
        "open_trip_id",
        F.col("open_trip_start_ts").cast("timestamp_ntz").alias("open_trip_start_ts"),
        F.col("last_ts").cast("timestamp_ntz").alias("last_ts"),
        "dt",
    )


@query
def trip_state_by_day(spark, sf):
    """The state after each file, from which the next day can be run by itself."""
    real, series = daily_ticks(spark, sf)
    out = T.trip_states(real, step_s=HOUR, config=DAILY_TRIPS, series=series)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("open_trip_start_ts", "last_ts")})


@query
def span_cluster(spark, sf):
    faults = events(spark, sf).where(F.col("fault_any") == 1)
    return T.spans(faults, USER, gap_s=24 * HOUR)


@query
def rising_spans(spark, sf):
    return T.rising_spans(events(spark, sf), USER, "value", rise=0.05, gap_s=24 * HOUR, min_rows=2)


# ---- windows


@query
def rolling_stats(spark, sf):
    out = W.rolling(events(spark, sf), USER, ["value"], [3, 10, 60])
    return rounded(out.select("event_id", *[c for c in out.columns if "_roll_" in c]))


@query
def rolling_skewed(spark, sf):
    """One series holds nearly all rows, and one of its times is far from all others."""
    e = events(spark, sf).withColumns(
        {
            "user_id": F.when(F.col("event_id") % 50 == 0, F.col("user_id")).otherwise(F.lit(0).cast("long")),
            "ts": F.when(F.col("event_id") == 7, F.lit("2099-01-01").cast("timestamp_ntz")).otherwise(F.col("ts")),
        }
    )
    out = W.rolling(e, Series("user_id", "ts", "event_id", max_rows=1_000), ["value"], [3, 10, 60])
    return rounded(out.select("event_id", *[c for c in out.columns if "_roll_" in c]))


@query
def rolling_sparse(spark, sf):
    """Frames with missing readings, filled from five readings on."""
    out = W.rolling(events(spark, sf), USER, ["reading"], [20, 60], min_periods=5)
    return rounded(out.select("event_id", *[c for c in out.columns if "_roll_" in c]), 8)


@query
def lags(spark, sf):
    out = W.lags(events(spark, sf), USER, ["value", "reading"], [1, 5, 20])
    return out.select("event_id", *[c for c in out.columns if "_lag_" in c])


@query
def future_label(spark, sf):
    out = W.future_label(events(spark, sf), USER, "reading", 5, "label", max_jump=100.0)
    return out.select("event_id", "reading", "label", "label_available")


@query
def position(spark, sf):
    """Place in the series; the first three rows are dropped."""
    return W.drop_first(events(spark, sf), USER, 3).select("event_id", "position")


@query
def rate_of_change(spark, sf):
    return rounded(W.change_rate(events(spark, sf), USER, "value", "rate").select("event_id", "rate"))


@query
def elapsed(spark, sf):
    return rounded(W.elapsed(events(spark, sf), USER).select("event_id", "elapsed_s"))


@query
def error_band(spark, sf):
    e = events(spark, sf).withColumns({"pred": F.col("value"), "error": F.col("reading") - 100})
    out = W.error_band(e, USER)
    return rounded(out.select("event_id", "err_std", "band_upper", "band_lower"))


@query
def window_features(spark, sf):
    """Gold rows: quality filter, all window columns in one pass, label jump filter."""
    e = user_sessions(spark, sf).where(F.col("trip_id").isNotNull())
    e = S.without_bits(e, "quality_flag", C.HARD_RANGE_BREACH | C.TIME_ANOMALY)
    out = W.window_features(
        e, Series("trip_id", "ts", "event_id"), ["value"], [2, 4], ["mean", "std", "min", "max"], [1, 2],
        "value", 1, "label",
    )
    out = out.where(W.plausible("value", "label", 200.0))
    made = [c for c in out.columns if "_roll_" in c or "_lag_" in c]
    return rounded(out.select("event_id", "trip_id", *made, "label", "label_available"))


# ---- resampling


def hourly(spark, sf, **classes) -> DataFrame:
    e = events(spark, sf).select("user_id", "ts", "event_id", "event_type", "reading", "quality_flag")
    e = e.withColumn("_seen", F.col("ts"))
    none = {"fast": [], "slow": [], "status": [], "counter": []}
    out = R.resample(
        e, ["user_id"], "ts", config=HOURLY, align="floor", order=["_seen", "event_id"], **{**none, **classes}
    )
    return rounded(out)


@query
def collapse_duplicates(spark, sf):
    e = events(spark, sf).withColumn("hour", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz"))
    e = e.select("user_id", "hour", "ts", "event_id", "event_type", "reading", "quality_flag")
    out = R.collapse_duplicates(e, ["user_id"], "hour", order=["ts", "event_id"])
    return rounded(out.select("user_id", "hour", "event_type", "reading", "quality_flag"))


@query
def resample_grid(spark, sf):
    return hourly(spark, sf).select("user_id", "ts", "reading", "event_type", "quality_flag")


@query
def fill_linear(spark, sf):
    return hourly(spark, sf, fast=["reading"]).select("user_id", "ts", "reading", "quality_flag")


@query
def fill_forward(spark, sf):
    out = hourly(spark, sf, slow=["reading"], status=["event_type"])
    return out.select("user_id", "ts", "reading", "event_type", "quality_flag")


@query
def fill_counter(spark, sf):
    out = hourly(spark, sf, counter=["reading"])
    return out.select("user_id", "ts", "reading", "quality_flag")


# ---- intervals


def fault_log(spark, sf) -> DataFrame:
    """Errors and purchases last two hours; the dearest purchases never end."""
    e = events(spark, sf).where(F.col("event_type").isin("error", "purchase"))
    endless = (F.col("event_type") == "purchase") & (F.col("value") > 300)
    return e.select(
        "user_id",
        F.col("event_id").alias("fault_id"),
        F.col("ts").alias("activated_at"),
        F.when(~endless, F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("fixed_at"),
        F.col("event_type").alias("code"),
    )


@query
def fault_flags(spark, sf):
    faults = intervals.clean_faults(fault_log(spark, sf))
    out = intervals.interval_flags(events(spark, sf).drop("fault_any"), faults, USER, ["error", "purchase"])
    return out.select("event_id", "fault_error", "fault_purchase", "fault_any")


@query
def many_code_flags(spark, sf):
    """Five thousand codes, one running value: how many are active at each event, which, and flags for two of them."""
    e = events(spark, sf).drop("fault_any")
    faults = e.where("event_type IN ('error', 'view')").select(
        "user_id",
        F.concat(F.lit("c"), F.col("event_id") % 5000).alias("code"),
        F.col("ts").alias("activated_at"),
        F.when(F.col("event_id") % 53 != 0, F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("event_id") % 70 - 2) * HOUR * 1_000_000)).alias("fixed_at"),
    )
    found = intervals.open_codes(e, faults, USER)
    flags = [F.array_contains("open_codes", c).cast("int").alias(f"fault_{c}") for c in ("c53", "c59")]
    return found.select("event_id", F.size("open_codes").cast("long").alias("n_open"), F.array_join("open_codes", ",").alias("codes"), *flags)


@query
def fault_code_universe(spark, sf):
    """Known codes and codes seen (here the cleaned brand names of parts)."""
    return intervals.code_universe(table(spark, sf, "part").select(S.fault_code("p_brand").alias("code")))


def pre_event(spark, sf) -> DataFrame:
    faults = fault_log(spark, sf).where(F.col("fixed_at").isNotNull())
    return intervals.pre_event_stats(
        events(spark, sf), faults, USER, ["value", "reading"], "fault_id", "activated_at", before_s=24 * HOUR, min_rows=2
    )


@query
def pre_event_stats(spark, sf):
    return rounded(pre_event(spark, sf))


@query
def pre_event_zscores(spark, sf):
    out = intervals.pre_event_zscores(pre_event(spark, sf), events(spark, sf), ["value", "reading"])
    return rounded(out.select("fault_id", "value_z", "reading_z"))


@query
def event_segments(spark, sf):
    faults = fault_log(spark, sf).where(F.col("fixed_at").isNotNull())
    out = intervals.event_segments(
        events(spark, sf), faults, USER, "fault_id", "activated_at", "fixed_at", before_s=HOUR, after_s=1800, bucket_s=HOUR
    )
    return out.select("event_id", "segment_event")


@query
def long_event_segments(spark, sf):
    """Every tenth fault lasts ten years, the others up to a day: each is cut into a few tiles."""
    faults = fault_log(spark, sf).select("user_id", "fault_id", "activated_at")
    length = F.when(F.col("fault_id") % 10 == 0, 3650 * 24 * HOUR).otherwise(F.col("fault_id") % 86_400)
    ended = F.timestamp_micros(F.unix_micros(F.col("activated_at").cast("timestamp")) + length * 1_000_000)
    out = intervals.event_segments(events(spark, sf), faults.withColumn("ended", ended), USER, "fault_id", "activated_at", "ended", before_s=2 * 24 * HOUR)
    return out.select("event_id", "segment_event")


@query
def day_slice(spark, sf):
    return intervals.day_slice(table(spark, sf, "events"), "ts", "2024-01-10").select("event_id", "user_id", "value")


# ---- cleaning


PRICE_RANGES = {
    "l_quantity": C.Range(soft=(5, 45), hard=(2, 49)),
    "l_extendedprice": C.Range(soft=(2000, 90000)),
    "l_discount": C.Range(hard=(0.01, 0.09)),
}


def checked_lines(spark, sf) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumn("quality_flag", F.lit(0))
    return S.check_ranges(df, PRICE_RANGES)


@query
def range_check(spark, sf):
    return checked_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "quality_flag")


@query
def bitmask_filter(spark, sf):
    return S.without_bits(checked_lines(spark, sf), "quality_flag", 16 | 32).select("l_orderkey", "l_linenumber", "quality_flag")


@query
def breach_counts(spark, sf):
    return clean.breach_counts(checked_lines(spark, sf))


@query
def null_rates(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(A.null_rates(checked_lines(spark, sf), names))


@query
def code_sanitise(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.fault_code(F.concat(F.lit("  "), "p_name", F.lit("--"), "p_type", F.lit("! "))).alias("code"))


@query
def parse_durations(spark, sf):
    parts = [F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"), F.lit("05")]
    text = F.when(F.col("l_returnflag") == "N", F.concat_ws(":", *parts[1:])).otherwise(F.concat_ws(":", *parts))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.seconds_of(text).alias("seconds"))


@query
def category_map(spark, sf):
    mapping = {"click": 1, "purchase": 1, "view": 0}
    padded = F.concat(F.lit(" "), F.upper("event_type"), F.lit("  "))
    return table(spark, sf, "events").select("event_id", S.category(padded, mapping).alias("state"))


@query
def parse_times(spark, sf):
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit("not a time"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d/M/yyyy HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    parsed = S.parse_time(text)
    return table(spark, sf, "orders").select("o_orderkey", parsed.cast("timestamp_ntz").alias("parsed"))


def order_files(spark, sf) -> DataFrame:
    """Orders as lines of five files, cut into splits of 1,000 keys."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("_file"),
        F.floor(F.col("o_orderkey") / 1000).alias("_block"),
        F.col("o_orderkey").alias("_row"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("timestamp"),
        F.col("o_orderpriority").alias("vehicle_id"),
        F.date_format("o_orderdate", "yyyy").alias("dt"),
        (F.col("o_totalprice") / 1000 - 50).alias("soc_pct"),
        F.lit(0).alias("quality_flag"),
    )


@query
def time_reversals(spark, sf):
    out = clean.flagged(order_files(spark, sf))
    return out.select(F.col("_row").alias("o_orderkey"), "quality_flag")


@query
def validation_report(spark, sf):
    out = clean.validation_report(clean.flagged(order_files(spark, sf)), ["vehicle_id"])
    out = out.select(
        "vehicle_id", "row_count_after_validation", "duplicate_timestamps", "bad_timestamps", "time_reversal_rows",
        "soft_range_breaches", "hard_range_breaches", F.col("null_rates.soc_pct").alias("null_rate_soc_pct"),
    )
    return rounded(out)


# ---- physics


def signals(spark, sf) -> DataFrame:
    """Order lines dressed as vehicle readings."""
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_shipdate",
        "l_returnflag",
        "l_linestatus",
        (p / 100).alias("stack_voltage_v"),
        (q - 25).alias("battery_current_a"),
        (p / 100 * (q - 20) / 1000).alias("output_power_kw"),
        (q * 20 - 400).alias("motor_speed_rpm"),
        (F.col("l_discount") * 1000).alias("motor_torque_value_nm"),
        (F.col("l_discount") + 3.5).alias("max_cell_voltage_v"),
        (F.col("l_tax") + 3.4).alias("min_cell_voltage_v"),
        (F.col("l_discount") * 40).alias("avg_cell_voltage_v"),
        (q + 1).alias("max_battery_temp_c"),
        (q - 1).alias("min_battery_temp_c"),
        (q - 10).alias("avg_battery_temp_c"),
        (q + 30).alias("motor_temperature_c"),
        (q + 20).alias("mcu_temperature_c"),
        (F.col("l_tax") * 500).alias("radiator_temperature_c"),
        (q * 2).alias("dcdc_input_voltage_v"),
        (F.col("l_discount") * 100).alias("dcdc_input_current_a"),
        F.lit(12.0).alias("dcdc_output_voltage_v"),
        q.alias("dcdc_output_current_a"),
    )


LINE = ("l_orderkey", "l_linenumber")


@query
def physics_columns(spark, sf):
    base = signals(spark, sf)
    out = S.physics(base)
    return rounded(out.select(*LINE, *[c for c in out.columns if c not in base.columns]), 9)


@query
def safe_ratio(spark, sf):
    ratio = S.safe_ratio(F.col("l_quantity") - 25, F.col("l_discount") - 0.05, 0.02)
    return rounded(table(spark, sf, "lineitem").select(*LINE, ratio.alias("ratio")))


@query
def charging_flags(spark, sf):
    df = signals(spark, sf).withColumns(S.charging_flags()).withColumn("is_physics_quiet", S.quiet_flag())
    return df.select(*LINE, "is_charging_current", "is_parked_charging", "is_physics_quiet")


@query
def align_columns(spark, sf):
    """The listed features only, absent ones and missing readings as 0."""
    e = events(spark, sf).withColumn("event_key", F.col("event_id"))
    return S.align_columns(e, ["event_key", "reading", "absent_signal"])


# ---- evaluation


def forecasts(spark, sf) -> DataFrame:
    """Order lines as scored rows: actual, prediction, current level."""
    q = F.col("l_quantity")
    df = table(spark, sf, "lineitem").select(
        *LINE,
        "l_suppkey",
        "l_returnflag",
        "l_shipdate",
        F.when(F.col("l_linestatus") == "O", "val").otherwise("train").alias("split"),
        (q * 2).alias("y"),
        (q * 2 + F.col("l_tax") * 50 - F.col("l_discount") * 40).alias("pred"),
        (q * 2 + F.round((F.col("l_discount") - 0.05) * 100)).alias("now"),
    )
    return evaluation.scored(df, "y")


@query
def scored_rows(spark, sf):
    return rounded(forecasts(spark, sf).select(*LINE, "y", "pred", "error", "abs_error"))


@query
def regression_metrics(spark, sf):
    return rounded(evaluation.regression_metrics(forecasts(spark, sf), "y", "pred"))


@query
def finite_metrics(spark, sf):
    df = forecasts(spark, sf).withColumn("pred", F.when(F.col("l_returnflag") == "N", F.lit(float("nan"))).otherwise(F.col("pred")))
    return rounded(evaluation.regression_metrics(df, "y", "pred", only_finite=True).select("rows", "mae", "rmse"))


@query
def group_metrics(spark, sf):
    return rounded(evaluation.regression_metrics(forecasts(spark, sf), "y", "pred", ["l_suppkey"]))


@query
def bucket_metrics(spark, sf):
    return rounded(evaluation.bucket_metrics(forecasts(spark, sf), "y", "pred", "now"))


@query
def actual_bucket_mae(spark, sf):
    return rounded(evaluation.actual_bucket_mae(forecasts(spark, sf), "y", "pred"))


@query
def error_distribution(spark, sf):
    return rounded(evaluation.error_distribution(forecasts(spark, sf)))


@query
def error_distribution_by_supplier(spark, sf):
    return rounded(evaluation.error_distribution(forecasts(spark, sf), by=["l_suppkey"]))


@query
def baseline_maes(spark, sf):
    return rounded(evaluation.baseline_maes(forecasts(spark, sf), "y", "now", "pred"))


@query
def slice_metrics(spark, sf):
    return rounded(evaluation.slice_metrics(forecasts(spark, sf), "y", "pred", "now"))


@query
def worst_rows(spark, sf):
    return rounded(evaluation.worst_rows(forecasts(spark, sf).withColumn("abs_error", F.round("abs_error", 6)), 25, ties=LINE).select(*LINE, "error"))


@query
def worst_row(spark, sf):
    df = forecasts(spark, sf).withColumn("abs_error", F.round("abs_error", 6))
    return rounded(evaluation.worst_row(df, ties=LINE).select(*LINE, "abs_error"))


@query
def tail_shares(spark, sf):
    return rounded(evaluation.tail_shares(forecasts(spark, sf).withColumn("abs_error", F.round("abs_error", 6))))


@query
def train_val_metrics(spark, sf):
    return rounded(evaluation.train_val_metrics(forecasts(spark, sf), "y", "pred"))


@query
def bias_and_drop(spark, sf):
    df = forecasts(spark, sf)
    return rounded(evaluation.bias_and_drop(df, ["l_suppkey"], "y", "error", "l_shipdate", LINE))


@query
def trip_error_summary(spark, sf):
    return rounded(evaluation.trip_summary(forecasts(spark, sf), "l_suppkey", "y"))


@query
def histogram(spark, sf):
    return rounded(evaluation.histogram(events(spark, sf), "value", 60))


@query
def histogram_by_split(spark, sf):
    return rounded(evaluation.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 80, ["l_linestatus"]))


@query
def sample_rows(spark, sf):
    return evaluation.sample_rows(table(spark, sf, "events"), 300, ["event_id"]).select("event_id", "value")


@query
def quantiles(spark, sf):
    cuts = {f"p{int(p * 100)}": p for p in (0.05, 0.25, 0.5, 0.75, 0.95)}
    return rounded(Q.exact_quantiles(events(spark, sf), "reading", cuts, ["event_type"]))


# ---- datasets


def customer_orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


CUSTOMER = ("o_custkey",)


@query
def training_rows(spark, sf):
    gold = signals(spark, sf).withColumns(
        {
            "quality_flag": F.when(F.col("battery_current_a") > 23, C.HARD_RANGE_BREACH).otherwise(0),
            "label_available": F.when(F.col("l_returnflag") != "R", 1).otherwise(0),
            "label": F.when(F.col("battery_current_a") != 0, F.col("output_power_kw")),
            "trip_id": F.col("l_suppkey"),
        }
    )
    features = ["stack_voltage_v", "battery_current_a", "is_charging_current", "is_parked_charging"]
    out = datasets.training_rows(gold, [*LINE, *features], "label", 52)
    return rounded(out.select(*LINE, *features, "label"), 9)


@query
def split_dates(spark, sf):
    df = customer_orders(spark, sf)
    days = [str(date(1995, 1, 1) + timedelta(n)) for n in range(365)]
    train = [d for d in days if d < "1995-07-01"]
    val = [d for d in days if d >= "1995-07-01"]
    return datasets.split_by_dates(df, train, val, CUSTOMER, "o_orderdate").select("o_orderkey", "split")


@query
def split_last_trips(spark, sf):
    df = customer_orders(spark, sf)
    return datasets.split_last_trips(df, 20, CUSTOMER, "o_orderdate").select("o_orderkey", "split")


@query
def split_by_share(spark, sf):
    df = customer_orders(spark, sf)
    return datasets.split_by_share(df, 0.2, CUSTOMER, "o_orderdate").select("o_orderkey", "split")


@query
def split_shuffled(spark, sf):
    df = customer_orders(spark, sf)
    return datasets.split_shuffled(df, 0.2, 42, CUSTOMER).select("o_orderkey", "split")


@query
def split_summary(spark, sf):
    split = datasets.split_by_share(customer_orders(spark, sf), 0.2, CUSTOMER, "o_orderdate")
    out = datasets.split_summary(split, CUSTOMER, "o_orderdate")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_start", "last_start")})


@query
def micro_trip_filter(spark, sf):
    out = A.filter_micro_trips(customer_orders(spark, sf), CUSTOMER, "o_totalprice", 8, 300000.0)
    return out.select("o_orderkey")


@query
def micro_trips_removed(spark, sf):
    return rounded(A.micro_trips(customer_orders(spark, sf), CUSTOMER, "o_totalprice", 8, 300000.0))


@query
def constant_report(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({"always_one": F.lit(1.0), "never": F.lit(None).cast("double")})
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "always_one", "never"]
    return rounded(A.constant_report(df, names), 8)


@query
def daily_stats(spark, sf):
    rows = silver(spark, sf)
    gold, trip_table = daily_gold(rows)
    return rounded(A.daily_rows(rows, gold, trip_table, C.HARD_RANGE_BREACH, min_rows=5))


def daily_gold(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    kept = S.without_bits(rows, "quality_flag", C.HARD_RANGE_BREACH).where(F.col("trip_id").isNotNull())
    keys = ("dt", "vehicle_id", "trip_id")
    gold = W.future_label(kept, Series(keys, "timestamp"), "reading", 2, "label", max_jump=50.0)
    return gold, A.trip_rows(gold, keys, "timestamp", level="reading", min_rows=2)


@query
def gold_totals(spark, sf):
    rows = silver(spark, sf)
    gold, trip_table = daily_gold(rows)
    return A.gold_totals(A.daily_rows(rows, gold, trip_table, C.HARD_RANGE_BREACH, min_rows=5))


@query
def ingest_manifest(spark, sf):
    e = events(spark, sf).withColumns({"dt": F.date_format("ts", "yyyy-MM-dd"), "vehicle_id": F.col("user_id").cast("string")})
    raw = e.select("dt", "vehicle_id", F.col("ts").alias("timestamp"))
    log = e.where(F.col("fault_any") == 1).select("dt", "vehicle_id", "ts")
    rows = silver(spark, sf).withColumn("fault_any", F.coalesce((F.col("fault_share") > 0).cast("int"), F.lit(0)))
    return A.ingest_manifest(raw, rows, log)


# ---- drift


DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def before_after(spark, sf) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem")
    lines = lines.withColumn("l_tax", F.when(F.col("l_returnflag") != "N", F.col("l_tax")))
    cut = F.lit("1997-01-01").cast("timestamp")
    newer = lines.where(F.col("l_shipdate") >= cut).withColumn("l_quantity", F.col("l_quantity") * 1.2)
    return lines.where(F.col("l_shipdate") < cut), newer


@query
def drift_baseline(spark, sf):
    return rounded(drift.baseline(before_after(spark, sf)[0], DRIFT_FEATURES))


def drift_pairs(spark, sf, sample: bool):
    old, new = before_after(spark, sf)
    fresh = drift.feature_values(new, DRIFT_FEATURES)
    if sample:
        ref = drift.feature_values(old, DRIFT_FEATURES)
    else:
        ref = drift.sketch_values(drift.baseline(old, DRIFT_FEATURES))
    pairs = stored(drift.paired_counts(ref, fresh), "pairs")
    return pairs, measure(pairs, Series(drift.FEATURE, "value"))


@query
def psi_sample(spark, sf):
    pairs, series = drift_pairs(spark, sf, True)
    return drift.psi(pairs, drift.edges(pairs, series), True)


@query
def psi_sketch(spark, sf):
    pairs, series = drift_pairs(spark, sf, False)
    return drift.psi(pairs, drift.edges(pairs, series), False)


@query
def ks_test(spark, sf):
    """By the limiting series, whatever the samples' sizes."""
    pairs, series = drift_pairs(spark, sf, True)
    return rounded(drift.ks(pairs, series, exact_upto=0).drop("ks_method"))


@query
def ks_exact(spark, sf):
    """Exact p-values of small samples: balances of two kinds of customers, nation by nation."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("feature"), F.col("c_acctbal").cast("double").alias("value"), "c_mktsegment")
    few = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    pairs = stored(drift.paired_counts(c.where(~few), c.where(few)), "pairs")
    return rounded(drift.ks(pairs, measure(pairs, Series(drift.FEATURE, "value"))))


MONTHS = ["l_quantity", "l_extendedprice", "l_tax"]


def line_months(spark, sf) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("l_tax", F.when(F.col("l_returnflag") != "N", F.col("l_tax")))
    return lines.withColumn("dt", F.date_format("l_shipdate", "yyyy-MM"))


@query
def merged_baseline(spark, sf):
    """Months of order lines summarised once; three years merged from their summaries, and whether the merged quantiles'
    true ranks are as near as stated."""
    lines = line_months(spark, sf)
    months = stored(summaries.daily_summaries(lines, MONTHS), "summaries")
    merged = summaries.summary_baseline(summaries.merged_summaries(months.where("dt BETWEEN '1994-01' AND '1996-12'")))
    values = drift.counted_values(drift.feature_values(lines.where("dt BETWEEN '1994-01' AND '1996-12'"), MONTHS)).where("value IS NOT NULL")
    near = F.lit(True)
    sums = []
    for name, q in drift.BASELINE_QUANTILES.items():
        below, upto = F.sum(F.when(F.col("value") < F.col(name), F.col("c")).otherwise(0)), F.sum(F.when(F.col("value") <= F.col(name), F.col("c")).otherwise(0))
        sums += [(below / F.sum("c")).alias(f"_lo_{name}"), (upto / F.sum("c")).alias(f"_hi_{name}")]
        near = near & (F.col(f"_lo_{name}") <= q + 2 * summaries.RANK_ERROR) & (F.col(f"_hi_{name}") >= q - 2 * summaries.RANK_ERROR)
    ranks = values.withColumnRenamed("n", "c").join(F.broadcast(merged), "feature").groupBy("feature").agg(*sums)
    out = merged.join(ranks, "feature").withColumn("within", near)
    return rounded(out.select("feature", "mean", "std", "null_rate", "n", "within"))


@query
def merged_drift(spark, sf):
    """Drift of a later range of months against an earlier one, from summaries alone."""
    months = stored(summaries.daily_summaries(line_months(spark, sf), MONTHS), "summaries")
    old, new = (summaries.merged_summaries(months.where(c)) for c in ("dt < '1997-01'", "dt >= '1997-01'"))
    return summaries.summary_drift(old, new).select("feature", "mean_ref", "mean_new", "null_rate_ref", "null_rate_new", (F.col("psi") < 0.05).alias("alike"))


@query
def merged_distinct(spark, sf):
    """Exact distinct values, users and times of each kind of event over a range of days, from bitmaps of single days.
    The ids of the first half's values are kept when the second half's are added."""
    e = events(spark, sf).withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).select("dt", "event_type", "user_id", "value", "ts")
    names = ["user_id", "value", "ts"]
    first = stored(summaries.dictionary(e.where("dt < '2024-01-15'"), names), "ids")
    ids = stored(summaries.dictionary(e, names, first), "ids")
    days = stored(summaries.distinct_bitmaps(e, names, ids, by=["event_type"]), "bitmaps")
    return summaries.distinct_counts(days.where("dt BETWEEN '2024-01-05' AND '2024-01-20'"), ["event_type"])


@query
def drift_report(spark, sf):
    old, new = before_after(spark, sf)
    return drift.drift_report(drift.baseline(old, DRIFT_FEATURES), new, old, exact_upto=0)


@query
def drift_summary(spark, sf):
    old, new = before_after(spark, sf)
    return drift.drift_summary(drift.drift_report(drift.baseline(old, DRIFT_FEATURES), new, old, exact_upto=0))


# ---- diagnostics


@query
def contradictions(spark, sf):
    return diagnostics.contradictions(signals(spark, sf), min_speed=20, still=0.5).select(*LINE)


@query
def level_jumps(spark, sf):
    labelled = W.future_label(events(spark, sf), USER, "value", 2, "label")
    return rounded(diagnostics.level_jumps(labelled, "value", "label", 150.0).select("event_id", "level_change"))


@query
def trip_bands(spark, sf):
    out = diagnostics.trip_bands(customer_orders(spark, sf), CUSTOMER, "o_orderdate")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("band_start", "band_end")})


# ---- model


FORECAST = C.ForecastConfig(
    features=("l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey"),
    target="y", max_iter=5, max_depth=3, min_instances=10,
)


def fitted_model(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("y", F.col("l_quantity") * 2)
    old = F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp")
    checkpoint_dir(spark)
    return boosting.fit(df.where(old), df.where(~old), FORECAST), df


@query
def fit_predict(spark, sf):
    """Boosted trees on older order lines, scored on all of them."""
    fitted, df = fitted_model(spark, sf)
    return rounded(model.predict(fitted, df, "y").select(*LINE, "y", "pred", "error"))


STUMP = C.ForecastConfig(
    features=("l_linenumber",), target="l_quantity", max_iter=1, max_depth=1, subsample=1.0, column_share=1.0, min_instances=1,
    step_size=1.0, l1=0.0, l2=0.0,
)


@query
def fit_stump(spark, sf):
    """One tree with one split, scored on all order lines."""
    checkpoint_dir(spark)
    df = table(spark, sf, "lineitem")
    return rounded(model.predict(boosting.fit(df, None, STUMP), df).select(*LINE, "pred"))


TWO_ROUNDS = C.ForecastConfig(
    features=("l_linenumber", "l_discount", "l_tax", "l_quantity"), target="y", max_iter=2, max_depth=2, step_size=0.5,
    subsample=1.0, column_share=1.0, min_instances=20, l1=3.0, l2=2.0,
)


@query
def fit_two_rounds(spark, sf):
    """Two rounds of trees with two levels and both penalties, scored on all order lines."""
    checkpoint_dir(spark)
    df = table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 1000)
    return rounded(boosting.predict(boosting.fit(df, None, TWO_ROUNDS), df).select(*LINE, "pred"))


@query
def feature_importance(spark, sf):
    return rounded(boosting.importance(fitted_model(spark, sf)[0], spark))


# ---- files and streams


@query
def file_fingerprints(spark, sf):
    return IO.fingerprints(spark, sf)


@query
def stored_days(spark, sf):
    """Events written as a partitioned table, and a range of its days and two of its series read back."""
    rows = events(spark, sf).select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.col("event_type").alias("vehicle_id"), "event_id", "value"
    )
    root = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    IO.write_table(rows, root, rebalance=True)
    back = IO.read_table(
        spark, root, vehicles=["error", "view"], columns=["dt", "vehicle_id", "event_id", "absent"],
        first_day="2024-01-05", last_day="2024-01-20",
    )
    return back


@query
def replaced_days(spark, sf):
    """Events written as a partitioned table, then two of its days replaced by other rows, and all read back."""
    rows = events(spark, sf).select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.col("event_type").alias("vehicle_id"), "event_id", "value"
    )
    days = ["2024-01-05", "2024-01-06"]
    root = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    IO.write_table(rows, root, rebalance=True)
    other = rows.where(F.col("dt").isin(*days) & (F.col("vehicle_id") == "error")).withColumn("value", F.col("value") * 2)
    IO.write_table(other, root, days, rebalance=True)
    return IO.read_table(spark, root, columns=["dt", "vehicle_id", "event_id", "value"])


@query
def cleaned_rows(spark, sf):
    """Vendor headers, readings as text with placeholders, an absent column and a 0/1 flag."""
    raw = table(spark, sf, "lineitem").select(
        *LINE,
        F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("Quantity"),
        F.when(F.col("l_linenumber") == 2, "NaN").otherwise(F.col("l_tax").cast("string")).alias("Tax rate"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).alias("Returned"),
    )
    named = clean.standardize(raw, {"Quantity": "quantity", "Tax rate": "tax", "Returned": "returned"})
    S.require(named, ["quantity", "tax"], "order lines")
    typed = named.withColumns(
        {"quantity": S.number("quantity"), "tax": F.nullif(S.number("tax"), F.lit(0.0)), "returned": S.truthy("returned")}
    )
    return S.ordered_columns(S.add_missing(typed, ["speed", "tax"], 0, "int"), LINE)


@query
def numeric_features(spark, sf):
    """Numeric columns that are not keys, with their NULL share."""
    df = table(spark, sf, "lineitem")
    names = S.choose_features(df, {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"})
    return rounded(A.null_rates(df, names))


@query
def streamed_trips(spark, sf):
    """Events as a stream: sessions closed by the watermark, numbered per user."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    closed = streams.session_stream(stream, "user_id", "ts", 4 * HOUR, "1 hour")
    out = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    streams.trip_stream(closed, "user_id", out, f"{out}/checkpoint", min_rows=2).awaitTermination()
    trips = spark.read.parquet(f"{out}/trips").drop("batch")
    return trips.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("trip_start_ts", "trip_end_ts")})


@query
def streamed_trip_states(spark, sf):
    """Events in four parts, each with times up to half an hour out of order, streamed one after the other from where the
    stream before stopped: trips that ended and trips that are open."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    out = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    moved = F.unix_micros("ts") + F.pmod(F.xxhash64("event_id"), F.lit(HOUR // 2 * 1_000_000))
    ends = e.agg(F.min(moved).alias("lo"), F.max(moved).alias("hi")).first()
    part = F.floor((moved - ends.lo) * 4 / (ends.hi - ends.lo + 1))
    for i in range(4):
        e.where(part == i).write.parquet(f"{out}/in/{i}")
        stream = spark.readStream.schema(e.schema).option("recursiveFileLookup", True).parquet(f"{out}/in")
        found = state_trips.trip_events(stream, "user_id", "ts", 4 * HOUR, "1 hour", min_rows=2)
        state_trips.write_trip_events(found, f"{out}/events", f"{out}/checkpoint").awaitTermination()
    trips = state_trips.current_trips(spark, f"{out}/events", "user_id")
    named = trips.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("trip_start_ts", "trip_end_ts")})
    return named.select("user_id", "trip_id", (F.col("status") == state_trips.CLOSED).alias("closed"), "trip_start_ts", "trip_end_ts", "rows")


@query
def incremental_load(spark, sf):
    """Events as raw CSV files of hourly readings, dropped in three parts of the month and loaded as they appear."""
    lake = jobs.Lake(f"{checkpoint_dir(spark)}/lakes/{uuid.uuid4().hex}")
    settings = jobs.Settings(resample=HOURLY, trips=DAILY_TRIPS)
    e = events(spark, sf)
    raw = e.select(
        F.date_format("ts", "dd/MM/yyyy HH:00:00").alias("Timestamp"), F.col("reading").alias("SOC (%)"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"), (F.col("user_id") % 4).cast("string").alias("vehicle_id"),
    )
    for part in range(3):
        days = raw.where(F.least(F.floor((F.dayofmonth(F.to_date("dt")) - 1) / 10), F.lit(2)) == part)
        IO.write_raw(days, lake.raw_files)
        loads.load_new_files(spark, lake, settings=settings).awaitTermination()
    valid, silver = (IO.read_table(spark, lake.at(t)) for t in ("raw_parquet", "silver"))
    out = A.ingest_manifest(valid, silver)
    out = out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("data_start_ts", "data_end_ts")})
    return out.select("dt", "vehicle_id", "raw_rows", "data_start_ts", "data_end_ts", "silver_rows", "num_trips")


@query
def trip_sets(spark, sf):
    """Trip rows of two feature tables put together by column name."""
    e = user_sessions(spark, sf).where(F.col("trip_id").isNotNull())
    errors = e.where(F.col("fault_any") == 1).groupBy("trip_id").agg(F.count(F.lit(1)).alias("errors"))
    rest = e.where(F.col("fault_any") == 0).groupBy("trip_id").agg(F.sum("value").alias("total"))
    return rounded(errors.unionByName(rest, allowMissingColumns=True))
