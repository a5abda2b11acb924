"""The daily load as files arrive: each batch of new raw files goes through check, grid and trips into the lake.

A batch leaves one record, written last. A batch that is run again after a failure finds either its record, and changes
nothing, or none, and replaces the days that it may have replaced before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wattline.plans import jobs
from wattline.sources import tables as IO
from wattline.streaming.stream import each_batch

FILE_LIST = "path string, modificationTime timestamp, length long, content binary"
Ingest = Callable[[SparkSession, jobs.Lake, Sequence[str], jobs.Settings], DataFrame]


def new_files(spark: SparkSession, lake: jobs.Lake, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the raw files that appear: path and length. Their content is not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_LIST).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(lake.raw_files).select("path", "length")


def load_new_files(
    spark: SparkSession,
    lake: jobs.Lake,
    name: str = "daily",
    settings: jobs.Settings = jobs.Settings(),
    files_per_batch: int | None = None,
    ingest: Ingest = jobs.ingest,
) -> StreamingQuery:
    """Load all raw files that have appeared since the last call, then stop.

    The days of the new files are loaded, and the days after the first of them that were loaded before: trips run on
    from day to day. `name` tells streams over one lake apart; it owns the checkpoint and the records under `loads/`.
    """

    def work(batch: DataFrame, number: int) -> None:
        load_batch(batch.sparkSession, lake, batch, number, name, settings, ingest)

    return each_batch(new_files(spark, lake, files_per_batch), work, lake.at(f"loads/{name}/checkpoint"))


def load_batch(spark: SparkSession, lake: jobs.Lake, batch: DataFrame, number: int, name: str, settings: jobs.Settings, ingest: Ingest = jobs.ingest) -> None:
    """One batch of (path, length), once."""
    record = lake.at(f"loads/{name}/records/batch={number}")
    if IO.exists(spark, record):
        return
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    files = batch.select(F.regexp_extract(path, IO.FOLDER_DAY, 1).alias("dt"), F.col("length"))
    found = files.groupBy("dt").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).where("dt <> ''").collect()  # one row a day
    fresh = sorted(r.dt for r in found)
    if not fresh:
        return
    loaded = IO.day_folders(spark, lake.at("silver"))
    days = sorted({*fresh, *(d for d in loaded if d > fresh[0])})
    manifest = ingest(spark, lake, days, settings)
    totals = manifest.agg(F.sum("raw_rows").alias("raw_rows"), F.sum("silver_rows").alias("silver_rows"))
    row = totals.select(
        F.lit(number).cast("long").alias("batch"),
        F.lit(sum(r.files for r in found)).cast("long").alias("files"),
        F.lit(sum(r.bytes for r in found)).cast("long").alias("bytes"),
        F.array(*[F.lit(d) for d in fresh]).alias("new_days"),
        F.array(*[F.lit(d) for d in days]).alias("loaded_days"),
        "raw_rows",
        "silver_rows",
    )
    draft = lake.at(f"loads/{name}/_draft_{number}")
    IO.delete(spark, draft)
    row.coalesce(1).write.parquet(draft)
    IO.make_folder(spark, lake.at(f"loads/{name}/records"))
    IO.rename(spark, draft, record)


def load_records(spark: SparkSession, lake: jobs.Lake, name: str = "daily") -> DataFrame:
    """One row per batch that was loaded."""
    return spark.read.parquet(*[f"{lake.at(f'loads/{name}/records')}/{f}" for f in IO.folders(spark, lake.at(f"loads/{name}/records"))])
