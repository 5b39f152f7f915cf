"""Helpers that several corpus operators share: scratch tables, text batches, ranks and components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Code points that part words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a Python worker handles at once, and bytes that they may have if they are more than one.
SLICE, SLICE_BYTES = 256, 8 << 20


def scratch_root(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir. A cluster must set it; only a local master has a folder of its own instead."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = f"/tmp/checkpoints/tidemark-{spark.sparkContext.applicationId}"
    return root.rstrip("/")


_OPEN: list[Scratch] = []


def release() -> None:
    """Delete every scratch table that is left, once no result that reads one is needed any more."""
    while _OPEN:
        _OPEN.pop().close()


@contextmanager
def closing() -> Iterator[None]:
    """Delete the scratch tables that were opened within, as soon as the results that read them are themselves written."""
    first = len(_OPEN)
    try:
        yield
    finally:
        while len(_OPEN) > first:
            _OPEN.pop().close()


def numbered(docs: DataFrame) -> tuple[DataFrame, list[str], list[Column]]:
    """docs with columns _0, _1, ..., which no operator uses, these names, and the columns that give back docs' own names."""
    names = [f"_{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names, [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]


class Scratch:
    """Tables written to the shared folder, to cut lineage; each can be dropped once nothing reads it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        _OPEN.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))
        return self.load(name, df)

    def load(self, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(like.schema) if like is not None else reader).parquet(self.path(name))

    def _folder(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def drop(self, name: str) -> None:
        files, path = self._folder(self.path(name))
        files.delete(path, True)

    def keep(self, *names: str) -> None:
        """Drop all tables but these."""
        files, root = self._folder(self.root)
        if files.exists(root):
            for found in files.listStatus(root):
                if found.getPath().getName() not in names:
                    files.delete(found.getPath(), True)

    def close(self) -> None:
        self.drop("")


def local_table(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A few driver-made rows as a local relation: Spark knows its size and broadcasts it only below its own threshold."""
    by_column = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
    return spark.createDataFrame(pa.table({n: pa.array(c, t) for (n, t), c in zip(columns.items(), by_column, strict=True)}))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; where it comes in fewer parts than there are cores, as a file with few row groups does, its rows are dealt out."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `size` rows and `most` bytes, or of one longer row, so that a worker's memory follows neither Arrow's batch size nor how many very long texts lie together."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size)
            while part.num_rows > 1 and part.nbytes > most:
                part = part.slice(0, part.num_rows // 2)
            yield part
            at += part.num_rows


def ranked(df: DataFrame, group: list[str], order: list[str], salt_on: Column, salts: int, name: str) -> DataFrame:
    """df with a rank from 0 within each group, without one task for a large group.

    Rows are dealt to `salts` parts of each group; the parts' counts give each part's first rank.
    The rank follows (part, order); it is reproducible if `order` and `salt_on` are.
    """
    parted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(salts)).cast("int"))
    counts = parted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select(*group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = W.partitionBy(*group, "_salt").orderBy(*order)
    at = parted.withColumn("_at", F.row_number().over(within))
    return at.join(first, [*group, "_salt"]).withColumn(name, F.col("_first") + F.col("_at") - 1).drop("_salt", "_first", "_at")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable over `edges` (u, v: long), for every node that has an edge.

    Each round, nodes and their current labels take the smallest label seen across an edge, then
    labels jump to their own label; the label table is written and reread, so lineage stays short.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = scratch.save(both, "edges")
    labels = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels-0")
    for k in count(1):
        of_u = labels.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        of_v = labels.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        seen = both.join(of_v, "v").join(of_u, "u").where("lv < lu")
        told = seen.select(F.explode(F.array("u", "lu")).alias("node"), F.col("lv").alias("told")).groupBy("node").agg(F.min("told").alias("told"))
        lower = labels.join(told, "node", "left").select("node", F.least("label", "told").alias("label"), F.col("label").alias("was"))
        # Written, so that both sides of the next join are dealt anew and a frequent label can be split.
        lower = scratch.save(lower, f"lower-{k}")
        # A label that was just lowered stands one step nearer its root.
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        jumped = lower.join(target, "label", "left").select("node", F.least("label", "jump").alias("label"), "was")
        now = scratch.save(jumped, f"labels-{k}")
        moved = now.where("label < was").limit(1).count()
        scratch.drop(f"labels-{k - 1}")
        scratch.drop(f"lower-{k}")
        labels = now.select("node", "label")
        if not moved:
            break
    scratch.drop("edges")
    return labels.select("node", F.col("label").alias("component"))
