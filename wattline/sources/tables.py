"""Lake layout `dt=…/vehicle_id=…`: raw CSV in, partitioned Parquet in and out, JSON and CSV reports."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wattline.config import FAULT_HEADERS, TIME_FORMATS
from wattline.functions.scalar import add_missing, parse_time

FILE_VEHICLE = r"(?i)vehicle_id=([^./]+)\.csv$"
FOLDER_DAY = r"/dt=([^/]+)/"
#: Files of more bytes are not read as one row to be hashed.
WHOLE = 16 << 20
BOM = b"\xef\xbb\xbf"


def vehicle_of(path: Column) -> Column:
    """Vehicle id from a file name; a name that does not fit fails the job."""
    found = F.regexp_extract(path, FILE_VEHICLE, 1)
    return F.when(found != "", found).otherwise(
        F.raise_error(F.concat(F.lit("cannot read a vehicle id from "), path))
    )


def _decoded_path() -> Column:
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def day_paths(root: str, days: Sequence[str] | None) -> list[str]:
    return [f"{root}/dt=*/*.csv"] if days is None else [f"{root}/dt={d}/*.csv" for d in days]


def existing_paths(spark: SparkSession, patterns: Iterable[str]) -> list[str]:
    """Those of the path patterns that match something."""
    return [p for p in patterns if _glob(spark, p)]


def _by_header(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The CSV files, all columns as text: one table for each header that occurs, however files order or
    extend their columns."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(list(paths)).select("value", _decoded_path().alias("file"), place.alias("at"))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    out = []
    for _, files in found:
        schema = spark.read.option("header", True).csv(files[0]).schema
        everything = list(paths) if len(found) == 1 else files
        out.append(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(everything))
    return out


def read_raw(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> DataFrame:
    """All columns of the raw files as text, by the names in each file's header, plus day, vehicle and the
    row's place in its file. Files are read once for their headers and once for their rows; a column that
    a file lacks is NULL there.
    """
    paths = existing_paths(spark, day_paths(root, days))
    if not paths:
        raise FileNotFoundError(f"no raw files under {root} for {days or 'any day'}")
    path = _decoded_path()
    tables = [
        rows.select(
            *[F.col(f"`{n}`") for n in rows.columns],
            F.regexp_extract(path, FOLDER_DAY, 1).alias("dt"),
            vehicle_of(path).alias("vehicle_id"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        for rows in _by_header(spark, paths)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_faults(
    spark: SparkSession, root: str, days: Sequence[str] | None = None, formats: Sequence[str] = TIME_FORMATS
) -> DataFrame:
    """Fault intervals of all files; days without a fault file simply have none."""
    empty = spark.createDataFrame(
        [], "dt string, vehicle_id string, activated_at timestamp, fixed_at timestamp, code string"
    )
    paths = existing_paths(spark, day_paths(root, days))
    if not paths:
        return empty
    path = _decoded_path()
    tables = [rows.withColumns({"dt": F.regexp_extract(path, FOLDER_DAY, 1), "vehicle_id": vehicle_of(path)}) for rows in _by_header(spark, paths)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    rows = add_missing(rows.withColumnsRenamed(FAULT_HEADERS), FAULT_HEADERS.values(), kind="string")
    return rows.select(
        "dt",
        "vehicle_id",
        parse_time("activated_at", formats).alias("activated_at"),
        parse_time("fixed_at", formats).alias("fixed_at"),
        "code",
    )


def read_table(
    spark: SparkSession,
    root: str,
    days: Sequence[str] | None = None,
    vehicles: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A partitioned table, pruned to days, an inclusive range of days, vehicles, and the columns it has.

    Only the folders of wanted days are looked into. Without a `schema` the columns are those of any of
    their files; with one, days without a folder give no rows instead of an error. Days and vehicles are text (`007`),
    whatever types the session guesses from folder names. A day that is just being replaced is read as it was
    before (see `write_table`).
    """
    found = day_folders(spark, root)
    if days is None and first_day is None and last_day is None and set(found.values()) <= {root}:
        paths = {root: [root]}
    else:
        wanted = [d for d in sorted(found) if (days is None or d in days) and (first_day or d) <= d <= (last_day or d)]
        paths = {base: [f"{base}/dt={d}" for d in wanted if found[d] == base] for base in dict.fromkeys(found[d] for d in wanted)}
    if not paths and schema is None:
        raise FileNotFoundError(f"{root} has none of the days asked for")
    if not paths:
        return spark.createDataFrame([], schema)

    def read(base: str) -> DataFrame:
        reader = spark.read.option("basePath", base)
        if schema is not None:
            return reader.schema(schema).parquet(*paths[base])
        found = reader.option("mergeSchema", True).parquet(*paths[base])
        if all(t == "string" for n, t in found.dtypes if n in ("dt", "vehicle_id")):
            return found
        # the session guesses types from folder names; a given schema takes the names as they are
        text = [StructField(f.name, StringType()) if f.name in ("dt", "vehicle_id") else f for f in found.schema]
        return spark.read.option("basePath", base).schema(StructType(text)).parquet(*paths[base])

    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(read, paths))
    if vehicles is not None:
        df = df.where(F.col("vehicle_id").isin(*vehicles))
    if columns is not None:
        df = df.select(*[c for c in dict.fromkeys(columns) if c in df.columns])
    return df


def day_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """day -> the folder that holds its `dt=` folder: the table's, or, for a day whose replacement was broken off between
    its two moves, the one that the old day was moved to."""
    names = folders(spark, root)
    out = {n.split("=", 1)[1]: root for n in names if n.startswith("dt=")}
    for old in sorted(n for n in names if n.startswith("_old_")):
        for n in folders(spark, f"{root}/{old}"):
            if n.startswith("dt="):
                out.setdefault(n.split("=", 1)[1], f"{root}/{old}")
    return out


def missing_files(df: DataFrame, days: Sequence[str], vehicles: Sequence[str]) -> DataFrame:
    """The wanted (day, vehicle) pairs the table has no rows for."""
    spark = df.sparkSession
    each_vehicle = F.explode(F.array(*[F.lit(v) for v in vehicles])) if vehicles else F.explode(F.array().cast("array<string>"))
    wanted = spark.createDataFrame([(d,) for d in days], "dt string").withColumn("vehicle_id", each_vehicle)
    return wanted.join(df.select("dt", "vehicle_id").distinct(), ["dt", "vehicle_id"], "left_anti")


def write_table(
    df: DataFrame,
    root: str,
    days: Sequence[str] | None = None,
    by: Sequence[str] = ("dt", "vehicle_id"),
    rebalance: bool = False,
) -> None:
    """Replace the partitions the rows belong to. With `days` those days are replaced as a whole: afterwards
    they have the partitions of these rows and no others. A rerun leaves the same table.

    With `days` the rows are written beside the table and each day is then moved into place; a day's old
    rows go after its new ones are there. `read_table` finds a day that has been moved away and whose successor isn't there
    yet, so that a day is the old or the new one at every moment, also if the job ends between the moves. Rows that were windowed by file lie together already; `rebalance`
    is for rows that are scattered.
    """
    spark = df.sparkSession
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    if days is None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(root)
        return
    if by[0] != "dt":
        raise ValueError("days are the first level of folders")
    mark = uuid.uuid4().hex[:12]
    draft, old = f"{root}/_draft_{mark}", f"{root}/_old_{mark}"
    df.write.partitionBy(*by).parquet(draft)
    fresh = {f for f in folders(spark, draft) if f.startswith("dt=")}
    _fs(spark, root).mkdirs(_path(spark, old))
    for day in sorted(fresh | {f"dt={d}" for d in days}):
        if exists(spark, f"{root}/{day}"):
            rename(spark, f"{root}/{day}", f"{old}/{day}")
        if day in fresh:
            rename(spark, f"{draft}/{day}", f"{root}/{day}")
    for done in (old, draft):
        delete(spark, done)
    for left in (n for n in folders(spark, root) if n.startswith("_old_")):  # of writers that broke off: these days have successors now
        for day in days:
            delete(spark, f"{root}/{left}/dt={day}")


def write_raw(df: DataFrame, root: str) -> None:
    """Raw files as `read_raw` finds them, `dt=…/vehicle_id=….csv`, from rows with dt and vehicle_id; a file that exists
    is replaced. One file per day and vehicle, so a file's rows meet in one task."""
    spark = df.sparkSession
    draft = f"{root}/_draft_{uuid.uuid4().hex[:12]}"
    df.repartition("dt", "vehicle_id").write.partitionBy("dt", "vehicle_id").option("header", True).csv(draft)
    for day in folders(spark, draft):
        make_folder(spark, f"{root}/{day}")
        for vehicle in folders(spark, f"{draft}/{day}"):
            target = f"{root}/{day}/{vehicle}.csv"
            delete(spark, target)
            rename(spark, _glob(spark, f"{draft}/{day}/{vehicle}/part-*.csv")[0], target)
    delete(spark, draft)


def write_json(df: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def fingerprints(
    spark: SparkSession, root: str, days: Sequence[str] | None = None, vehicles: Sequence[str] | None = None, whole: int = WHOLE
) -> DataFrame:
    """First 16 hex digits of the SHA-256 of every Parquet file, by path below `root`. Only files of the
    wanted days and vehicles are listed and read.

    A file of up to `whole` bytes is one row. A larger one is read in pieces, which end where a byte is a line feed, by one
    task from its beginning to its end; only a stretch of 2 GB without that byte is too long.
    """
    names = [f"vehicle_id={{{','.join(vehicles)}}}"] if vehicles is not None else []
    patterns = ["/".join([root, f"dt={d}", *names]) for d in days] if days is not None else ["/".join([root, "dt=*", *names]) if names else root]
    paths = patterns if patterns == [root] else existing_paths(spark, patterns)
    if not paths:
        return spark.createDataFrame([], "file string, sha256 string")

    def files(kind: str, **options: str) -> DataFrame:
        # recursiveFileLookup keeps the folder names out of the columns
        return spark.read.format(kind).options(recursiveFileLookup=True, pathGlobFilter="*.parquet", **options).load(paths)

    small = files("binaryFile").where(F.col("length") <= whole).select("path", F.sha2("content", 256).alias("digest"))
    # what a codec that can't be split reads is one block; this one changes nothing. Libraries name its option in different ways
    codec = spark._jvm.org.apache.hadoop.io.compress.PassthroughCodec
    pieces = files("text", lineSep="\n", **{"io.compression.codecs": codec.CLASSNAME, codec.OPT_EXTENSION: ".parquet"})
    pieces = pieces.where(F.col("_metadata.file_size") > whole).select(
        _decoded_path().alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("piece"),
    )
    hashed = small.unionByName(pieces.mapInArrow(_digests, "path string, digest string"))
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    out = hashed.withColumn("file", F.regexp_extract(path, r"((?:dt=[^/]+/)?(?:vehicle_id=[^/]+/)?[^/]+)$", 1))
    return out.select("file", F.concat(F.lit("sha256:"), F.substring("digest", 1, 16)).alias("sha256"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of files whose pieces (path, size of the file, bytes with a line feed) come in order, file by file."""
    path, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hex()])], ["path", "digest"])

    for batch in batches:
        if not batch.num_rows:
            continue
        paths, sizes, pieces = batch.columns
        codes = paths.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            if paths[begin].as_py() != path:
                if path is not None:
                    yield row()
                path, digest = paths[begin].as_py(), _Digest(sizes[begin].as_py(), pieces[begin].as_py())
            digest.add(pieces[begin:end])
    if path is not None:
        yield row()


class _Digest:
    """SHA-256 of a file from its pieces. Two things are known only at the end, by the file's size: whether the last line feed is the
    file's, and whether it begins with a byte order mark, which the reader of text leaves out."""

    def __init__(self, size: int, first: bytes):
        self.size, self.read = size, 0
        self.starts = {s: hashlib.sha256(s) for s in ([b""] if first.startswith(b"PAR1") else [b"", BOM])}

    def add(self, pieces: pa.Array) -> None:
        bounds = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        begin, end = int(bounds[0]), int(bounds[-1])
        for h in self.starts.values():
            if self.read:
                h.update(b"\n")
            h.update(memoryview(pieces.buffers()[2])[begin : end - 1])
        self.read += end - begin

    def hex(self) -> str:
        for start, h in self.starts.items():
            left_over = self.size - len(start) - self.read
            if left_over == 0:
                h.update(b"\n")
            if left_over in (0, -1):
                return h.hexdigest()
        raise ValueError(f"read {self.read} bytes of a file of {self.size}")


# ---- file system, through Hadoop, so that any store works


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return [s.getPath().toString() for s in found] if found else []


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below."""
    if not exists(spark, root):
        return []
    return [s.getPath().getName() for s in _fs(spark, root).listStatus(_path(spark, root)) if s.isDirectory()]


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def create(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one."""
    return _fs(spark, path).createNewFile(_path(spark, path))


def delete(spark: SparkSession, path: str | None) -> None:
    if path:
        _fs(spark, path).delete(_path(spark, path), True)


def stored_path(df: DataFrame) -> str | None:
    """Folder of the one stored table that df reads; None if it has no files."""
    files = df.inputFiles()
    return files[0].rpartition("/")[0] if files else None


def rename(spark: SparkSession, old: str, new: str) -> None:
    if not _fs(spark, old).rename(_path(spark, old), _path(spark, new)):
        raise OSError(f"could not move {old} to {new}")
