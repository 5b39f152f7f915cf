"""Streams: bars that appear once they have closed, and datasets that are scored once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timebars import ANCHOR


def closed_bars(stream: DataFrame, keys: list[str], minutes: int, value: str, late_minutes: int = 0, ts: str = "ts", anchor: int = ANCHOR) -> DataFrame:
    """(keys, bar, close_ts, open, high, low, close, n): a bar is emitted when the watermark passes its close; later rows are dropped.

    For append mode. Works on a batch as well, where every bar is emitted.
    """
    timed = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", f"{late_minutes} minutes")
    window = F.window("_t", f"{minutes} minutes", f"{minutes} minutes", f"{anchor % minutes} minutes")
    bars = timed.groupBy(*keys, window.alias("_w")).agg(F.min_by(value, "_t").alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, "_t").alias("close"), F.count(F.lit(1)).alias("n"))
    zoneless = lambda c: F.col(c).cast("timestamp_ntz")
    return bars.select(*keys, zoneless("_w.start").alias("bar"), zoneless("_w.end").alias("close_ts"), "open", "high", "low", "close", "n")


def event_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def on_new_datasets(spark: SparkSession, folder: str, schema, checkpoint: str, handle: Callable[[DataFrame, int], None], multi_line: bool = False) -> StreamingQuery:
    """Call handle with the manifests that are new since the last time, and their batch's number.

    The checkpoint makes it once for each, but for a batch whose handling broke off: it comes again,
    with the same rows under the same number. A handler that writes should therefore write by number
    (see by_batch).
    """
    stream = spark.readStream.schema(schema).option("multiLine", multi_line).json(folder)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch as a partition batch_id of its own and writes it over if it comes again, so that no row is there twice."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")

    return write
