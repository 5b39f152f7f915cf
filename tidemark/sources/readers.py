"""Reading and writing time-keyed tables, labels, signals, prices, manifests."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

TIME_NAMES = ("datetime", "timestamp", "ts", "date")  # fixed values, in order of preference
TIME_FORMATS = ("dd-MM-yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyyMMdd")
_FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc"}


_LEFT: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir, which all machines share; only a local master has a folder of its own instead."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = f"/tmp/checkpoints/tidemark-{spark.sparkContext.applicationId}"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _LEFT.append((spark, path))
    return path


def drop(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Delete every scratch folder, once no result that reads one is needed any more."""
    while _LEFT:
        drop(*_LEFT.pop())


def parse_time(text: Column, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """The first format that fits, as a zoneless time; null if none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats))


def numeric_time(value: Column, magnitude: float) -> Column:
    """Epoch seconds, milli-, micro- or nanoseconds, yyyymmdd or a spreadsheet's day number, told apart by the column's median."""
    if magnitude > 1e17:
        made = F.timestamp_micros((value / 1000).cast("long"))
    elif magnitude > 1e14:
        made = F.timestamp_micros(value.cast("long"))
    elif magnitude > 1e11:
        made = F.timestamp_millis(value.cast("long"))
    elif magnitude > 1e8:
        made = F.timestamp_seconds(value)
    elif magnitude > 1e7:
        made = F.try_to_timestamp(value.cast("long").cast("string"), F.lit("yyyyMMdd"))
    else:
        made = F.timestamp_seconds((value - 25569) * 86400)
    return made.cast("timestamp_ntz")


def time_column(df: DataFrame) -> str:
    """Name of the table's time column; refuses zoned times, whose wall clock depends on the session."""
    by_name = {f.name.lower(): f for f in reversed(df.schema.fields)}
    found = next((by_name[n] for n in TIME_NAMES if n in by_name), None) or next((f for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))), None)
    if found is None:
        raise ValueError(f"no time column among {df.columns}")
    if isinstance(found.dataType, T.TimestampType):
        raise ValueError(f"{found.name} has a time zone; give wall-clock times")
    return found.name


def time_keyed(df: DataFrame) -> DataFrame:
    """df with its time column as ts; rows without a time are dropped."""
    name = time_column(df)
    ts = F.col(name) if isinstance(df.schema[name].dataType, T.TimestampNTZType) else parse_time(F.col(name).cast("string"))
    return df.withColumn(name, ts).withColumnRenamed(name, "ts").where("ts is not null")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """By extension; headers are stripped of blanks; an empty table is refused."""
    kind = next((f for ext, f in _FORMATS.items() if path.rstrip("/").lower().endswith(ext)), None)
    if kind is None:
        raise ValueError(f"{path}: one of {', '.join(_FORMATS)} is needed")
    reader = spark.read.format(kind)
    df = (reader.option("header", True).option("ignoreLeadingWhiteSpace", True) if kind == "csv" else reader).load(path)
    df = df.toDF(*(c.strip() for c in df.columns))
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each parquet table below folder: path, group (first sub-folder) and cleaned name; refuses equal names.

    A table is a file, or a directory whose name ends in .parquet, however many files are in it.
    """
    from tidemark.functions.labels import clean_name

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder).select("path")
    root = folder.rstrip("/").split(":")[-1].lstrip("/")
    below = F.regexp_replace("path", f"^.*{re.escape(root)}/", "")
    inside = F.regexp_extract(below, r"^(?:[^/]+/)*?[^/]*\.parquet(/.*)?$", 1)  # of the first directory that is a table
    cut = lambda c: F.left(c, F.length(c) - F.length(inside))
    tables = files.select(cut(F.col("path")).alias("path"), cut(below).alias("_below")).distinct()
    parts = F.split("_below", "/")
    named = tables.select("path", F.when(F.size(parts) > 1, parts[0]).alias("group"), clean_name(F.regexp_replace(F.element_at(parts, -1), r"\.parquet$", "")).alias("name"))
    twice = [r["name"] for r in named.groupBy("name").count().where("count > 1").limit(5).collect()]
    if twice:
        raise ValueError(f"several tables are named {', '.join(twice)}")
    return named


def folder_changes(found: DataFrame, known: DataFrame) -> DataFrame:
    """(name, change) of files by name: kept, moved (another path), new (not known) or orphan (known, but not found)."""
    both = found.select("name", F.col("path").alias("_now")).join(known.select("name", F.col("path").alias("_was")), "name", "full")
    change = F.when(F.col("_was").isNull(), "new").when(F.col("_now").isNull(), "orphan").when(F.col("_now") != F.col("_was"), "moved").otherwise("kept")
    return both.select("name", change.alias("change"))


def bad_share(df: DataFrame, text: str, parsed: Column) -> float:
    """Share of non-null texts that don't parse."""
    row = df.agg(F.avg(F.when(F.col(text).isNotNull(), parsed.isNull().cast("int"))).alias("x")).first()
    return row["x"] or 0.0


def clean_labels(df: DataFrame, time: str, label: str, weight: str) -> DataFrame:
    """ts, label, weight: day-first times, else by any known format for the whole column; refuses over 1 % that stay unread."""
    first = F.try_to_timestamp(F.col(time), F.lit(TIME_FORMATS[0])).cast("timestamp_ntz")
    ts = first if bad_share(df, time, first) <= 0.01 else parse_time(F.col(time))
    if bad_share(df, time, ts) > 0.01:
        raise ValueError(f"{time}: over 1 % of the times can't be read")
    out = df.select(ts.alias("ts"), F.trim(label).alias("label"), F.col(weight).try_cast("double").alias("weight")).where("ts is not null")
    refuse_duplicates(out, ["ts"])
    return out


def refuse_duplicates(df: DataFrame, keys: list[str]) -> None:
    found = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if found:
        raise ValueError(f"repeated keys, such as {found}")


def dedupe(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, values, conflict): equal repeats become one row; a key with different values is a conflict."""
    same = df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_low"), F.max(F.struct(*values)).alias("_high"))
    return same.select(*keys, *(F.col(f"_low.{v}").alias(v) for v in values), (~F.col("_low").eqNullSafe(F.col("_high"))).alias("conflict"))


def signals(df: DataFrame, ts: str, signal: str, split: str | None = None) -> DataFrame:
    """ts, sig: upper-cased and trimmed; of several splits only test."""
    own = df.where(F.lower(F.trim(split)) == "test") if split else df
    return own.select(F.col(ts).alias("ts"), F.upper(F.trim(signal)).alias("sig"))


def schema_gaps(actual: T.StructType, expected: T.StructType) -> dict[str, list[str]]:
    """Missing and extra columns, and those that turned from text to number or back; from footers, no rows are read."""
    have, want = {f.name: f.dataType for f in actual}, {f.name: f.dataType for f in expected}
    is_text = lambda t: isinstance(t, (T.StringType, T.BooleanType))
    return {"missing": [n for n in want if n not in have], "extra": [n for n in have if n not in want], "flipped": [n for n in want if n in have and is_text(have[n]) != is_text(want[n])]}


def stamp(df: DataFrame, column: str, **facts: str) -> DataFrame:
    """df with facts in the column's metadata, which parquet keeps."""
    return df.withMetadata(column, {**df.schema[column].metadata, **facts})


def read_stamp(df: DataFrame, column: str, **wanted: str) -> dict:
    """The column's facts; refuses missing or different ones."""
    found = df.schema[column].metadata
    for name, value in wanted.items():
        if found.get(name) != value:
            raise ValueError(f"{column}: {name} is {found.get(name)!r}, not {value!r}")
    return found


def write_certified(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Written, read again, and compared in columns, types and rows."""
    rows = df.count()
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    again = df.sparkSession.read.parquet(path)
    if sorted(again.dtypes) != sorted(df.dtypes) or again.count() != rows:
        raise ValueError(f"{path} doesn't hold what was written")
    return again.select(*df.columns)


def write_csv(df: DataFrame, path: str, time_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    df.write.mode("errorifexists").option("header", True).option("timestampNTZFormat", time_format).option("timestampFormat", time_format).csv(path)


def export_predictions(df: DataFrame, true: str, pred: str) -> DataFrame:
    """With a correct column of YES and NO, or without truth if there is none."""
    if df.where(F.col(true).isNotNull()).isEmpty():
        return df.drop(true)
    return df.withColumn("correct", F.when(F.col(true).isNotNull() & F.col(pred).isNotNull(), F.when(F.col(true) == F.col(pred), "YES").otherwise("NO")))


def write_report(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as a directory of its own."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")


WHOLE = 16 << 20  # bytes of a file that is read as one value, of which a task holds a few copies
VALUE = 1 << 30  # the same where files can't be read in pieces
CHUNK = 8 << 20


def _stored(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(quote(re.sub("^file:/(?!/)", "file:///", uri), safe=":/@"))


def _in_pieces(uri: str) -> bool:
    """Whether Arrow finds a file, so that it can be read in pieces."""
    try:
        store, path = _stored(uri)
        return store.get_file_info(path).is_file
    except (OSError, pa.ArrowException):
        return False


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files' digests, read a piece at a time through the file systems that Arrow knows."""
    for batch in batches:
        digests = []
        for uri in batch.column("path").to_pylist():
            store, path = _stored(uri)
            digest = hashlib.sha256()
            with store.open_input_stream(path) as stream:
                while piece := stream.read(CHUNK):
                    digest.update(piece)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(digests, pa.string())], names=["path", "sha256"])


def content_hashes(spark: SparkSession, path: str, whole: int = WHOLE) -> DataFrame:
    """path, sha256 of every file below path but empty ones, which Spark doesn't list.

    Files of up to `whole` bytes are read as values, on any storage that Spark reads. Longer ones
    are streamed by the executors in pieces, a file to a task, from storage that Arrow reads (local,
    HDFS, S3, GCS). On any other storage files of up to VALUE bytes are values too, which takes
    executors with room for them; for longer ones, which no value can hold from 2 GB on, the job
    fails and says so.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    longer = files.where(F.col("length") > whole).select("path").first()  # contents aren't read
    if longer is not None and not _in_pieces(longer["path"]):
        whole = max(whole, VALUE)
    small = files.where(F.col("length") <= whole).select("path", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return small.unionByName(large.repartition(parts, "path").mapInArrow(_streamed, "path string, sha256 string"))


def code_hashes(spark: SparkSession, path: str, glob: str = "*.ipynb") -> DataFrame:
    """path, sha256 of the code cells of every notebook below path: outputs, counts and notes don't change it."""
    schema = "cells array<struct<cell_type: string, source: array<string>>>"
    cells = F.from_json(F.col("content").cast("string"), schema)["cells"]
    code = F.array_join(F.transform(F.filter(cells, lambda c: c["cell_type"] == "code"), lambda c: F.array_join(c["source"], "")), "\n")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2(code.cast("binary"), 256).alias("sha256"))


def most_recent(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The n latest rows, in order."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n).orderBy(*order)


def row_ids(df: DataFrame, order: list[str], name: str = "unique_index") -> DataFrame:
    """df with ids from 0 in order: ranges are numbered on their own and start where the ones before end.

    Ranges come from a sample, which differs each time it is drawn, so rows are written with theirs
    before they are counted and numbered.
    """
    path = scratch(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_from"))
    within = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return ranged.withColumn("_at", within).join(starts, "_range").withColumn(name, F.col("_from") + F.col("_at") - 1).drop("_range", "_at", "_from")
