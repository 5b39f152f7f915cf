"""Exact top-k inner products by aggregation without random access (NRA).

Vectors are dealt to blocks; in a block, each dimension is a list of components in sorted order. A
query reads a list downwards where its weight is positive and upwards where it is negative, a
stretch at a time and all lists in step. What has been read of a vector raises its lower bound
(unread components count as the list's worst), which is an exact integer; its upper bound lets
unread ones count as the last that was read. After each stretch the bounds of some vectors tell
whether a stop is near; if so, what was read since the last look is added to the lower bounds of
all that are left, and vectors that can qualify for no open query any more are dropped. A query's
reading stops when few vectors but the k best lower bounds can still qualify. These few are then
scored in full, so when to look at all bounds decides the work and never the result. Each block's
k best per query are merged by Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch

SCALE = 256
BLOCK, QUERIES = 4096, 32768  # vectors in a block, queries in a block, about
STEP = 256  # queries that a task bounds at once
STRETCHES = 12  # in which a list is read
SOME = 256  # vectors of a block that are bounded after every stretch, about
WORTH = 0.5  # part of the open queries that must be near a stop for a look at all bounds
FEW = 20  # times k vectors, or one in FEW of the block, that are worth resolving
LIMIT = 2.0**61  # that a score's parts may sum to in 64-bit integers


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def scaled(vector: Column) -> Column:
    """floor(256 x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


class Lists:
    """A block's vectors as sorted lists, one for each dimension, that queries read in step.

    Every list stands twice, to be read downwards and upwards; a query's weights are 0 where it
    doesn't read that way.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors.astype(np.int64)
        n = len(ids)
        order = np.argsort(self.vectors, axis=0, kind="stable")
        at = np.empty_like(order)
        np.put_along_axis(at, order, np.arange(n)[:, None], axis=0)
        self.place = np.concatenate([n - 1 - at, at], axis=1)  # where an entry stands in its list
        upwards = np.take_along_axis(self.vectors, order, axis=0)
        self.sorted = np.concatenate([upwards[::-1], upwards], axis=1)
        self.some = np.arange(0, n, -(-n // SOME) or 1)  # vectors whose bounds tell when all are worth bounding
        self.read = np.zeros(2, dtype=np.int64)  # entries that queries read, and entries that their lists have
        self.bounded = 0  # pairs of a query and a vector whose bounds were taken

    def _stretches(self) -> list[int]:
        """Ends of the stretches: short ones first, for tables in which a few entries decide."""
        n = len(self.ids)
        return sorted({-(-n * k // STRETCHES) for k in range(1, STRETCHES + 1)} | {-(-n // 64), -(-n // 32)})

    def best(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of its k best, ties to the smaller id, without the query's own id.

        `lower` holds the open queries' lower bounds of the vectors that may still qualify for any
        of them; a look at the bounds adds the entries that were read since the last one.
        """
        (n, width), out = self.vectors.shape, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        queries = queries.astype(np.int64)
        if not n or not len(queries):
            return out
        bound = float(np.abs(queries).max(axis=0).astype(float) @ np.abs(self.vectors).max(axis=0).astype(float))
        if bound >= LIMIT:
            raise ValueError("inner products go beyond 64-bit integers")
        kind = np.float64 if bound < 2.0**51 else np.int64  # sums of integers below 2**53 are exact in either
        ways = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(kind)
        worst = self.sorted[-1]
        over = (np.concatenate([self.vectors, self.vectors], axis=1) - worst).astype(kind)  # what an entry is better by
        slack = 1 + bound * 1e-12  # outweighs rounding
        enough = max(FEW * k, n // FEW)
        open_, alive, place, looked = np.arange(len(queries)), np.arange(n), self.place, 0
        lower = np.repeat((ways @ worst.astype(kind))[:, None], n, axis=1)  # all entries unread

        def unread(places: np.ndarray, to: int) -> np.ndarray:
            return np.where(places < to, 0, (self.sorted[to - 1] - worst).astype(float))  # at most the last that was read

        for to in self._stretches():
            asked = ways[open_]
            if to < n and not self._near(asked, over, unread, to, 2 * enough / n):
                continue
            lower += asked @ np.where((place >= looked) & (place < to), over[alive], 0).T
            looked = to
            upper = lower + asked @ unread(place, to).T + slack
            own = self.ids[None, alive] == query_ids[open_, None]
            upper[own] = -np.inf
            others = np.where(own, np.iinfo(np.int64).min // 2, lower)
            may = upper >= np.partition(others, -k, axis=1)[:, -k, None] if len(alive) > k else ~own  # no other can qualify any more
            done = (may.sum(axis=1) <= enough) | (to == n)
            for row in np.flatnonzero(done).tolist():
                few = alive[may[row]]
                score = self.vectors[few] @ queries[open_[row]]
                top = np.lexsort((self.ids[few], -score))[:k]
                out[open_[row]] = (self.ids[few][top], score[top])
            self.read += int(done.sum()) * width * np.array([to, n])
            self.bounded += len(open_) * len(alive)
            open_ = open_[~done]
            if not len(open_):
                break
            keep = (may | own)[~done].any(axis=0)
            alive, place, lower = alive[keep], place[keep], lower[~done][:, keep]
        return out

    def _near(self, asked: np.ndarray, over: np.ndarray, unread, to: int, share: float) -> bool:
        """Whether some vectors' bounds say that the candidates of a part of the queries are few by now."""
        place = self.place[self.some]
        lower = asked @ np.where(place < to, over[self.some], 0).T
        upper = lower + asked @ unread(place, to).T
        return ((upper >= lower.max(axis=1)[:, None]).mean(axis=1) <= share).mean() >= WORTH


def _block_best(k: int, width: int):
    def run(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts: list[np.ndarray] = [np.zeros((0, 4), dtype=np.int64)]
        if len(queries) and len(rows):
            lists = Lists(rows["vec_id"].to_numpy(dtype=np.int64), _matrix(rows["vector"], width))
            for at in range(0, len(queries), STEP):
                asked = queries.iloc[at : at + STEP]
                found = lists.best(_matrix(asked["vector"], width), asked["vec_id"].to_numpy(dtype=np.int64), k)
                for row, query_id, (ids, scores) in zip(asked["row"], asked["vec_id"], found, strict=True):
                    parts.append(np.stack([np.full(len(ids), query_id), np.full(len(ids), row), ids, scores], axis=1))
        return pd.DataFrame(np.concatenate(parts), columns=["query_id", "query_row", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products over all rows but its own.

    Vectors that are null or hold null or non-finite components, and rows without an id, take no
    part. Shorter vectors count as ending in zeros. Repeated queries give their rows once each;
    repeated rows are candidates each; rows with the query's id are its own. Fewer candidates than k give all. Queries and
    vectors meet in blocks of bounded size, none of which holds all of either.
    """
    spark = vectors.sparkSession

    def prepared(df: DataFrame, name: str, size: int) -> tuple[DataFrame, int, int]:
        own = df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("vector"))
        own = scratch.save(own.withColumn("row", F.monotonically_increasing_id()), name)
        facts = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
        blocks = max(1, -(-facts["n"] // size))
        return own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), blocks, facts["width"] or 0

    rows, row_blocks, width = prepared(vectors, "rows", BLOCK)
    asked, query_blocks, query_width = prepared(queries, "queries", QUERIES)
    rows = rows.withColumnRenamed("block", "rb").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = asked.withColumnRenamed("block", "qb").withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    grouped = asked.groupBy("qb", "rb").cogroup(rows.groupBy("qb", "rb"))
    found = grouped.applyInPandas(_block_best(k, max(width, query_width)), "query_id long, query_row long, vec_id long, score long")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for those whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), Scratch(spark, "top-k"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
