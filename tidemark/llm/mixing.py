"""Mixing sources to target weights: nested hash thresholds found from histograms, then a plain filter.

A document's hash decides which passes of its source take it. Whole passes take everything; the one
partial pass takes hashes below a threshold, found from sums by source and hash bucket: the bucket
in which the budget ends is cut into finer buckets, on its own rows only, until single hashes are
left. A hash is over id and text, so rows that share one are equal; as many of them are taken as come
nearest the budget. A smaller budget has a smaller threshold, so its documents are among those of a larger one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import WORD, Scratch, local_table, numbered, ranked, shuffle_partitions, table

WEIGHTS = (5, 2, 1)
MOST = 3  # times its source's size that a target may be, and its own size that a document may give
HASH_BITS, STEP_BITS = 48, 12


def hash48(id_col: Column, *more: Column) -> Column:
    """48 bits of MD5 over the id's text and whatever else tells rows apart; SQL engines agree on it."""
    said = F.concat_ws("/", *(F.coalesce(c.cast("string"), F.lit("")) for c in (id_col, *more)))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Shares of the total by weight, each at most `most` times its source's size; the excess goes to the others by weight."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(ordered)}
    size, total = dict(ordered), sum(n for _, n in ordered)
    out: dict[str | None, float] = {}
    free = list(size)
    while free:
        left, of = total - most * sum(size[s] for s in out), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] > most * size[s] * of]
        if not over:
            out |= {s: left * weight[s] / of for s in free}
            break
        out |= {s: float(most * size[s]) for s in over}
        free = [s for s in free if s not in out]
    return out


@dataclass
class _Cut:
    """A source's partial pass: its budget, and what lies below the bucket in which it ends."""

    budget: float
    below: int = 0
    bucket: int = 0  # of the bits that have been looked at
    whole: int = 0  # the bucket's own sum
    rows: int = 1  # and its rows

    def taken(self) -> int:
        """How many of the last bucket's rows, which are equal, come nearest the budget."""
        return math.ceil((2 * (self.budget - self.below) * self.rows - self.whole) / (2 * self.whole))


def _cuts(spark: SparkSession, sized: DataFrame, budgets: dict[str | None, float]) -> dict[str | None, _Cut]:
    """For each source the hash in which its budget ends."""
    cuts = {s: _Cut(b) for s, b in budgets.items()}
    rows = sized
    for level in range(HASH_BITS // STEP_BITS):
        shift = HASH_BITS - STEP_BITS * (level + 1)
        now = local_table(spark, [(s, float(c.budget), c.below, c.bucket) for s, c in cuts.items()], _source=pa.string(), _budget=pa.float64(), _below=pa.int64(), _prefix=pa.int64())
        sums = rows.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("sum"), F.count(F.lit(1)).alias("rows"))
        sums = sums.join(now, F.col("source").eqNullSafe(F.col("_source"))).where(F.shiftright("bucket", STEP_BITS) == F.col("_prefix"))
        upto = F.col("_below") + F.sum("sum").over(W.partitionBy("source").orderBy("bucket"))
        ends = sums.withColumn("upto", upto).where(F.col("upto") > F.col("_budget"))
        ends = ends.groupBy("source").agg(F.min(F.struct("bucket", "upto", "sum", "rows")).alias("end"))
        found = {r["source"]: r["end"] for r in ends.collect()}  # a row for each source
        cuts = {s: _Cut(c.budget, found[s]["upto"] - found[s]["sum"], found[s]["bucket"], found[s]["sum"], found[s]["rows"]) for s, c in cuts.items() if s in found}
        if not cuts:
            return {}
        at = local_table(spark, [(s, c.bucket) for s, c in cuts.items()], _source=pa.string(), _prefix=pa.int64())
        own = F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("hash", shift) == F.col("_prefix"))
        rows = rows.join(at, own, "left_semi")
    return cuts


def _thresholds(spark: SparkSession, sized: DataFrame, budgets: dict[str | None, float]) -> dict[str | None, int]:
    """For each source the hash below which all documents are taken."""
    return {s: c.bucket + (c.taken() == c.rows) for s, c in _cuts(spark, sized, budgets).items()}


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    doc_id = F.col(id_col).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), hash48(doc_id, F.col(text_col)).alias("hash"))


def _plan(spark: SparkSession, sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """A row for each source: _source, source_size, target, _passes (what every document is taken), _cut (hashes below are taken once more) and _equal (rows of that hash that are)."""
    totals = [(r["source"], r["n"] or 0) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    target = targets(totals, weights, most)
    passes = {s: math.floor(target[s] / n) if n else 0 for s, n in totals}
    budgets = {s: target[s] - passes[s] * n for s, n in totals}
    cuts = _cuts(spark, sized, {s: b for s, b in budgets.items() if b > 0})
    rows = [(s, n, float(target[s]), passes[s], *((cuts[s].bucket, cuts[s].taken()) if s in cuts else (0, 0))) for s, n in totals]
    return local_table(spark, rows, _source=pa.string(), source_size=pa.int64(), target=pa.float64(), _passes=pa.int64(), _cut=pa.int64(), _equal=pa.int64())


def _timed(placed: DataFrame, source: str) -> DataFrame:
    """Rows with _passes, _cut, _equal and _hash, which also get _times. Only rows of the cut's own hash, usually one a source, are counted."""
    below = placed.where("_hash <> _cut or _equal = 0").withColumn("_times", F.col("_passes") + (F.col("_hash") < F.col("_cut")).cast("long"))
    at_cut = placed.where("_hash = _cut and _equal > 0").withColumn("_row", F.monotonically_increasing_id())
    at_cut = ranked(at_cut, [source], ["_row"], F.col("_row"), shuffle_partitions(placed.sparkSession), "_k")
    return below.unionByName(at_cut.withColumn("_times", F.col("_passes") + (F.col("_k") < F.col("_equal")).cast("long")).drop("_row", "_k"))


def mix(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each row of docs: doc_id, source, size, source_size, target, taken, times (how often the mix has it).

    Size is the text's words (null: 0). Sources are sorted by code point, null last, and weigh
    `weights` in turn. A source without words has target 0. Rows that share a doc_id, or have none,
    are told apart by their texts; of equal rows as many are taken as come nearest the target. The
    sources' totals (a row for each source) are the only thing gathered. Further columns are not read.
    """
    sized = scratch.save(_sized(docs, id_col, text_col, source_col), "sized")
    plan = _plan(docs.sparkSession, sized, weights, most)
    placed = sized.withColumnRenamed("hash", "_hash").join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return _timed(placed, "_source").select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("_times")).alias("taken"), F.col("_times").alias("times"))


def mixed_documents(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs' rows as often as the mix has them, by a filter on each row's own hash; see mix for the rules."""
    sized = scratch.save(_sized(docs, id_col, text_col, source_col), "sized")
    plan = _plan(docs.sparkSession, sized, weights, most).select("_source", "_passes", "_cut", "_equal")
    own, names, back = numbered(docs)
    source, doc_id, text = (names[docs.columns.index(c)] for c in (source_col, id_col, text_col))
    placed = own.withColumn("_hash", hash48(F.col(doc_id).cast("long"), F.col(text))).join(plan, own[source].cast("string").eqNullSafe(F.col("_source")))
    placed = _timed(placed, "_source").where("_times > 0")
    return placed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*back)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix over all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mix(docs, Scratch(spark, "mixing")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce(text, '')), 1, 12)) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
r AS (  -- sources by size for each unit of weight; those before may stop at 3 times their size
  SELECT *, sum(n) OVER () - 3 * coalesce(sum(n) OVER (ORDER BY n * 1.0 / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
         sum(w) OVER (ORDER BY n * 1.0 / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws,
         row_number() OVER (ORDER BY n * 1.0 / w, source) AS k
  FROM s),
f AS (SELECT min(k) AS k FROM r WHERE budget * w <= 3 * n * ws),
t AS (
  SELECT r.source, r.n, CASE WHEN r.k < f.k THEN CAST(3 * r.n AS DOUBLE)
         ELSE CAST(b.budget * r.w AS DOUBLE) / CAST(b.ws AS DOUBLE) END AS target
  FROM r, f JOIN r b ON b.k = f.k),
p AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS q FROM t),
g AS (
  SELECT source, h, sum(size) AS gs, count(*) AS gc FROM d GROUP BY source, h),
c AS (
  SELECT g.*, sum(gs) OVER (PARTITION BY g.source ORDER BY h) AS cum, p.target - p.q * p.n AS budget FROM g JOIN p ON g.source IS NOT DISTINCT FROM p.source),
e AS (  -- how many of the equal rows of a hash are taken once more
  SELECT *, CASE WHEN cum <= budget THEN gc WHEN cum - gs >= budget THEN 0 ELSE ceil((2 * (budget - (cum - gs)) * gc - gs) / (2 * gs)) END AS more FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY source, h) AS k FROM d)
SELECT o.doc_id, o.size, p.n AS source_size, p.target, CAST(o.size * (p.q + CASE WHEN o.k <= e.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source
JOIN e ON o.source IS NOT DISTINCT FROM e.source AND o.h = e.h
"""
