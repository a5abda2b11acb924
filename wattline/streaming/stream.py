"""Streaming counterparts: validation, sessions, numbered trips with kept counters, daily loads.

Open trips live in Spark's session-window state, so a late row may still join or merge them. A trip
gets its number when the watermark closes it; only the last number per key is kept between batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wattline.config import RANGES
from wattline.functions.scalar import check_ranges
from wattline.operators import clean
from wattline.operators.series import Series, positions
from wattline.sources.tables import folders

SECOND = 1_000_000


def validate_stream(raw: DataFrame, time: str = "timestamp", **kwargs) -> DataFrame:
    """The row-by-row part of validation: names, types, times and ranges. The check against the row
    before needs a file order and stays with the batch job."""
    parsed = clean.parsed(clean.standardize(raw), time, **kwargs)
    return check_ranges(parsed.where(F.col(time).isNotNull()), RANGES)


def session_stream(
    rows: DataFrame,
    key: str,
    time: str,
    gap_break: int,
    delay: str,
    step_s: int = 1,
    aggregates: Sequence[Column] = (),
) -> DataFrame:
    """One row per session, closed where at least `gap_break` steps are missing. Rows more than `delay`
    behind the newest are dropped. Gives the same sessions in batch."""
    # a session window merges rows up to and including its gap
    gap = (gap_break + 1) * step_s * SECOND - 1
    window = F.session_window(F.col(time), f"{gap} microseconds")
    out = rows.withWatermark(time, delay).groupBy(key, window).agg(
        F.min(time).alias("trip_start_ts"),
        F.max(time).alias("trip_end_ts"),
        F.count(F.lit(1)).alias("rows"),
        *aggregates,
    )
    return out.drop("session_window")


def number_trips(closed: DataFrame, key: str, counters: DataFrame | None, min_rows: int = 1) -> tuple[DataFrame, DataFrame]:
    """Numbers for newly closed sessions, after the counters kept so far; and the new counters.

    A session that is too short spends its number without becoming a trip.
    """
    ranked = positions(closed, Series(key, "trip_start_ts"), "_rank")
    if counters is None:
        counters = closed.select(key).limit(0).withColumn("trip_seq", F.lit(0).cast("long"))
    known = counters.withColumnRenamed("trip_seq", "_before")
    number = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_rank") + 1
    numbered = ranked.join(known, key, "left").withColumn("trip_seq", number)
    named = numbered.where(F.col("rows") >= min_rows).withColumn(
        "trip_id", F.format_string("%s_%06d", F.col(key).cast("string"), F.col("trip_seq"))
    )
    after = numbered.select(key, "trip_seq").unionByName(counters).groupBy(key).agg(F.max("trip_seq").alias("trip_seq"))
    return named.drop("_rank", "_before", "trip_seq"), after


def trip_stream(sessions: DataFrame, key: str, out: str, checkpoint: str, min_rows: int = 1) -> StreamingQuery:
    """Write numbered trips under `out/trips` and counters under `out/counters`, one folder per batch.

    A batch that is run again after a failure starts from the counters before it and overwrites what it
    wrote.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        counters = counters_before(spark, out, batch_id)
        trips, after = number_trips(batch, key, counters, min_rows)
        trips.write.mode("overwrite").parquet(f"{out}/trips/batch={batch_id}")
        after.write.mode("overwrite").parquet(f"{out}/counters/batch={batch_id}")
        batch.unpersist()

    return each_batch(sessions, work, checkpoint)


def counters_before(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    kept = [int(f.split("=")[1]) for f in folders(spark, f"{out}/counters") if f.startswith("batch=")]
    earlier = [b for b in kept if b < batch_id]
    return spark.read.parquet(f"{out}/counters/batch={max(earlier)}") if earlier else None


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run `work` on everything new, then stop: the incremental daily load. `work` must be repeatable,
    as the jobs' writes are, because a batch is run again after a failure."""
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
