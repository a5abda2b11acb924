"""Numbered trips from keyed state: each key keeps its counter, its open trip and the rows that are not final yet.

Rows may come in any order within the watermark's delay. A row is final once the watermark has passed it; final rows are
folded in time order into the open trip. A timer per key wakes it when its next row becomes final or its trip has
surely ended. Work and state follow the keys that have rows or a timer due; nothing is written for the others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wattline.streaming.stream import SECOND, each_batch

STATES = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OPENED, GROWN, CLOSED = "opened", "grown", "closed"


class TripProcessor(StatefulProcessor):
    """Emits a row whenever a trip has become long enough (`opened`), has got more rows (`grown`) or has ended (`closed`).

    Times are microseconds. A trip ends where the next row is `gap` or more later; one with fewer than `min_rows` rows
    spends its number and is never emitted.
    """

    def __init__(self, gap: int, min_rows: int):
        self.gap, self.min_rows = gap, min_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # number of the newest trip; its first and last time and rows; whether it is open; whether it was emitted
        self.trip = handle.getValueState("trip", "seq long, start long, last long, rows long, open boolean, told boolean")
        self.pending = handle.getListState("pending", "at long, rows long")

    # the columns of a part lose names that begin with an underscore
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh: Counter = Counter()
        for part in rows:
            for at, n in part["at_us"].value_counts().items():
                fresh[int(at)] += int(n)
        return self.fold(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self.fold(key, Counter(), timerValues.getCurrentWatermarkInMs())

    def fold(self, key, waiting: Counter, watermark_ms: int) -> Iterator[pd.DataFrame]:
        now = max(watermark_ms, 0) * 1000
        for at, n in self.pending.get():
            waiting[at] += n
        seq, start, last, rows, is_open, told = self.trip.get() if self.trip.exists() else (0, 0, 0, 0, False, False)
        before, events = rows, []

        def tell(status: str) -> None:
            events.append((seq, status, start, last, rows))

        for at in sorted(a for a in waiting if a <= now):
            if is_open and at - last >= self.gap:
                if rows >= self.min_rows:
                    tell(CLOSED)
                is_open = False
            if not is_open:
                seq, start, rows, is_open, told, before = seq + 1, at, 0, True, False, 0
            last, rows = at, rows + waiting.pop(at)
        if is_open and now >= last + self.gap - 1:
            if rows >= self.min_rows:
                tell(CLOSED)
            is_open = False
        elif is_open and rows >= self.min_rows and rows > before:
            tell(GROWN if told else OPENED)
            told = True
        self.trip.update((seq, start, last, rows, is_open, told))
        self.pending.clear()
        if waiting:
            self.pending.put(sorted(waiting.items()))
        self.wake(waiting, last, is_open)
        if events:
            yield self.table(key, events)

    def wake(self, waiting: Counter, last: int, is_open: bool) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = [*waiting, *([last + self.gap - 1] if is_open else [])]
        if due:
            self.handle.registerTimer(-(-min(due) // 1000))

    @staticmethod
    def table(key, events) -> pd.DataFrame:
        out = pd.DataFrame(events, columns=["trip_seq", "status", "start_us", "end_us", "rows"])
        out.insert(0, "trip_key", key[0])
        return out


def trip_events(rows: DataFrame, key: str, time: str, gap_break: int, delay: str, step_s: int = 1, min_rows: int = 1) -> DataFrame:
    """A stream of trip rows: key, trip_seq, trip_id, status, trip_start_ts, trip_end_ts, rows.

    A trip ends where at least `gap_break` steps are missing. Rows that the watermark has passed are dropped, and so are
    rows without a key or time. Trips are those that a batch over the same rows finds.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATES)
    kind = rows.schema[key].dataType.simpleString()
    wanted = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    wanted = wanted.select(F.col(key).alias("trip_key"), F.col(time), F.unix_micros(F.col(time).cast("timestamp")).alias("at_us"))
    found = wanted.groupBy("trip_key").transformWithStateInPandas(
        TripProcessor((gap_break + 1) * int(step_s * SECOND), min_rows),
        outputStructType=f"trip_key {kind}, trip_seq long, status string, start_us long, end_us long, rows long",
        outputMode="Append",
        timeMode="EventTime",
    )
    return found.select(
        F.col("trip_key").alias(key), "trip_seq", F.format_string("%s_%06d", F.col("trip_key").cast("string"), "trip_seq").alias("trip_id"),
        "status", F.timestamp_micros("start_us").alias("trip_start_ts"), F.timestamp_micros("end_us").alias("trip_end_ts"), "rows",
    )


def write_trip_events(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Everything new, one folder per batch; a batch that is run again replaces its folder."""
    return each_batch(events, lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}"), checkpoint)


def current_trips(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The newest row of each trip: its state after the last batch."""
    events = spark.read.option("basePath", out).parquet(out).withColumn("batch", F.col("batch").cast("long"))
    rows = F.struct(*[c for c in events.columns if c != "batch"])
    latest = F.struct("batch", F.col("status") == CLOSED)  # a trip has at most two rows in a batch
    return events.groupBy(key, "trip_seq").agg(F.max_by(rows, latest).alias("r")).select("r.*")
