"""Fingerprints of texts as Merkle trees over paragraphs and sections, with DataFrame functions only.

A paragraph is a line, a section a run of paragraphs that ends with an empty line, with a paragraph
whose digest starts with 0 to 3, or with the text; so sections average four paragraphs and an edit
leaves the sections around it as they are. A text's fingerprint is the root over its sections'
digests: equal fingerprints are equal texts. Where roots differ, the first and last differing
sections, and in them the first and last paragraphs that the other text doesn't have, bound the
edit. How alike two trees are is measured inside the paragraphs, by their clauses.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import shuffle_partitions

#: A clause ends with its punctuation; longer ones are cut, so that a length fits in LENGTH_BITS. Nothing is given back, so that no match is nested.
CLAUSE = r"[^.!?,;:\n]{1,60000}+[.!?,;:]{0,5000}+|[.!?,;:]{1,60000}+"
LENGTH_BITS = 16


def paragraphs(text: Column) -> Column:
    """The lines of a text: line (from 0), digest, n (code points)."""
    return F.transform(F.split(text, "\n", -1), lambda p, k: F.struct(k.alias("line"), F.sha2(F.concat(F.lit("p"), p), 256).alias("digest"), F.length(p).alias("n")))


def section_ends(lines: Column) -> Column:
    """How many paragraphs have been taken at the end of each section."""
    ends = F.transform(lines, lambda p, k: F.when((p["digest"] < "4") | (p["n"] == 0) | (k == F.size(lines) - 1), k + 1))
    return F.filter(ends, lambda k: k.isNotNull())


def sections(lines: Column, ends: Column) -> Column:
    """digest and paragraphs of each section."""

    def section(end: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(ends, k - 1)).otherwise(0)
        own = F.slice(lines, before + 1, end - before)
        return F.struct(F.sha2(F.concat(F.lit("s"), F.array_join(own["digest"], "")), 256).alias("digest"), own.alias("paragraphs"))

    return F.transform(ends, section)


def clauses(text: Column) -> Column:
    """The different clauses of a text as longs: a hash above, the length in code points in the lowest LENGTH_BITS."""
    low = (1 << LENGTH_BITS) - 1
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(CLAUSE), F.lit(0)), lambda c: F.xxhash64(c).bitwiseAND(F.lit(~low)).bitwiseOR(F.length(c).cast("long"))))


def with_tree(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """df with name_sections, name_root and name_clauses of a text column that has no null."""
    text = F.col(text_col)
    df = df.withColumns({"_lines": paragraphs(text), f"{name}_clauses": clauses(text)})
    df = df.withColumn("_ends", section_ends(F.col("_lines")))
    df = df.withColumn(f"{name}_sections", sections(F.col("_lines"), F.col("_ends")))
    root = F.sha2(F.concat(F.lit("r"), F.array_join(F.col(f"{name}_sections.digest"), "")), 256)
    return df.withColumn(f"{name}_root", root).drop("_lines", "_ends")


def _weight(keys: Column) -> Column:
    return F.aggregate(keys, F.lit(0).cast("long"), lambda n, k: n + k.bitwiseAND((1 << LENGTH_BITS) - 1))


def likeness(a: str, b: str) -> Column:
    """The part of two texts' different clauses, by length, that both have: 1 for equal roots, 0 where unequal texts have none."""
    both, all_ = _weight(F.array_intersect(f"{a}_clauses", f"{b}_clauses")), _weight(F.col(f"{a}_clauses")) + _weight(F.col(f"{b}_clauses"))
    return F.when(F.col(f"{a}_root") == F.col(f"{b}_root"), 1.0).when(all_ > 0, 2.0 * both / all_).otherwise(0.0)


def edit_bounds(a: str, b: str) -> tuple[Column, Column]:
    """The first and last line of text a under branches that text b doesn't have; null where all sections of a are in b too."""
    own, others = F.col(f"{a}_sections"), F.flatten(F.transform(f"{b}_sections", lambda s: s["paragraphs"]["digest"]))

    def outermost(order) -> Column:
        digests = order(own["digest"])
        differing = F.get(F.array_except(digests, F.col(f"{b}_sections")["digest"]), F.lit(0))
        section = F.get(order(own), (F.array_position(digests, differing) - 1).cast("int"))["paragraphs"]
        lines = order(section)
        changed = F.get(F.array_except(lines["digest"], others), F.lit(0))
        at = F.coalesce(F.nullif(F.array_position(lines["digest"], changed), F.lit(0)), F.lit(1))
        return F.when(differing.isNotNull(), F.get(lines, (at - 1).cast("int"))["line"])

    return outermost(lambda x: x), outermost(F.reverse)


# --- each document's next one --------------------------------------------------------------------

_ORDER = ("_missing", "_falling", "_hash", "_tie")
_KEY = "struct<_missing: boolean, _falling: bigint, _hash: bigint, _tie: bigint>"


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (null: empty), and what orders documents by falling id, null last; rows that share an id go by their text's hash, then by where they stand."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    falling = F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long"))
    return own.withColumns({"_missing": F.col("doc_id").isNull(), "_falling": falling, "_hash": F.xxhash64("text"), "_tie": F.xxhash64(F.monotonically_increasing_id())})


def _bucket(bounds: list[dict]) -> Column:
    """How many bounds a row's key has reached, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    key = F.struct(*_ORDER)
    reached = lambda of: F.size(F.filter(of, lambda x: x <= key))
    firsts = F.from_json(F.lit(json.dumps([g[0] for g in groups])), f"array<{_KEY}>")
    group = reached(firsts)
    own = F.get(F.from_json(F.lit(json.dumps(groups)), f"array<array<{_KEY}>>"), group - 1)
    return F.when(group == 0, 0).otherwise((group - 1) * width + reached(own))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and next_text: the text of the document after it, by falling id; the last one's next is the first.

    Documents are dealt once, into ranges of ids of equal size, and looked up within each; a
    range's last document has the next range's first. The ranges' bounds, one for each partition,
    are all that is gathered. Rows that share an id, however many, can lie in several ranges.
    """
    spark = docs.sparkSession
    rows = _in_order(docs, id_col, text_col)
    dealt = rows.select(*_ORDER).repartitionByRange(shuffle_partitions(spark), *_ORDER)
    lowest = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*_ORDER)).alias("key"))
    bounds = sorted((r["key"].asDict() for r in lowest.collect()), key=lambda k: [k[c] for c in _ORDER])
    order = W.partitionBy("_bucket").orderBy(*_ORDER)
    rows = rows.withColumn("_bucket", _bucket(bounds[1:]))
    rows = rows.withColumns({"_after": F.lead("text").over(order), "_at": F.row_number().over(order)})
    # A row for each range.
    firsts = rows.where("_at = 1").select("_bucket", F.col("text").alias("_first"))
    of = F.coalesce(F.lag("_bucket").over(W.orderBy("_bucket")), F.max("_bucket").over(W.partitionBy()))
    firsts = firsts.select("_first", of.alias("_bucket"))
    return rows.join(firsts, "_bucket").select("doc_id", "text", F.coalesce("_after", "_first").alias("next_text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, root and sections (digest; paragraphs: line, digest, n) of every text; null is an empty text, and every row has its own."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    return with_tree(own, "_text", "own").select("doc_id", F.col("own_root").alias("root"), F.col("own_sections").alias("sections"))


def compared(texts: DataFrame, a_col: str, b_col: str) -> DataFrame:
    """texts with a_root, b_root, likeness, first_edit and last_edit (lines of text a) of two text columns; null is an empty text."""
    a, b = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (a_col, b_col))
    both = with_tree(with_tree(texts.withColumns({"_a": a, "_b": b}), "_a", "a"), "_b", "b")
    first, last = edit_bounds("a", "b")
    return both.select(*texts.columns, "a_root", "b_root", likeness("a", "b").alias("likeness"), first.alias("first_edit"), last.alias("last_edit"))


def edit_audit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against its text with the last half taken from the next document, and against the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    first_edit and last_edit (the lines of the own text that bound the edit; null without one). A
    single document is its own next. Null texts are empty ones; null ids come last; an empty table
    gives no row; further columns are not read.
    """
    pairs = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    pairs = pairs.withColumn("edited", edited)
    for text, name in (("text", "own"), ("edited", "edited"), ("next_text", "next")):
        pairs = with_tree(pairs, text, name)
    first, last = edit_bounds("own", "edited")
    found = {"edited_sha256": F.sha2("edited", 256), "fingerprint": F.col("own_root"), "edited_fingerprint": F.col("edited_root"), "near_edited": likeness("own", "edited"), "near_next": likeness("own", "next"), "first_edit": first, "last_edit": last}
    return pairs.select("doc_id", "n_chars", *(c.alias(n) for n, c in found.items()))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return edit_audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: Clauses are compared as texts; none of the tables' is so long that it would be cut.
SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS k, doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
e AS (SELECT *, coalesce(lead(text) OVER (ORDER BY k), first_value(text) OVER (ORDER BY k)) AS following FROM d),
x AS (SELECT *, substr(text, 1, n - n // 2) || substr(following, 1, n // 2) AS edited FROM e),
t AS (
  SELECT k, 'own' AS kind, text FROM x UNION ALL SELECT k, 'edited', edited FROM x UNION ALL SELECT k, 'next', following FROM x),
p AS (
  SELECT k, kind, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM t),
q AS (SELECT k, kind, line, p, sha256('p' || p) AS digest FROM p),
c AS (
  SELECT *, coalesce(sum(CASE WHEN digest < '4' OR p = '' THEN 1 ELSE 0 END) OVER (PARTITION BY k, kind ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS section FROM q),
s AS (SELECT k, kind, section, sha256('s' || string_agg(digest, '' ORDER BY line)) AS digest FROM c GROUP BY k, kind, section),
r AS (SELECT k, kind, sha256('r' || string_agg(digest, '' ORDER BY section)) AS root FROM s GROUP BY k, kind),
l AS (
  SELECT k, kind, list_distinct(regexp_extract_all(text, '[^.!?,;:\n]+[.!?,;:]*|[.!?,;:]+')) AS clauses FROM t),
w AS (SELECT *, coalesce(list_sum(list_transform(clauses, lambda y: length(y))), 0) AS weight FROM l),
near AS (
  SELECT a.k, b.kind, CASE WHEN ra.root = rb.root THEN 1.0::DOUBLE WHEN a.weight + b.weight = 0 THEN 0.0::DOUBLE
         ELSE 2.0::DOUBLE * coalesce(list_sum(list_transform(list_intersect(a.clauses, b.clauses), lambda y: length(y))), 0)::DOUBLE / (a.weight + b.weight)::DOUBLE END AS near
  FROM w a JOIN w b ON a.k = b.k AND a.kind = 'own' AND b.kind <> 'own' JOIN r ra ON ra.k = a.k AND ra.kind = 'own' JOIN r rb ON rb.k = b.k AND rb.kind = b.kind),
ds AS (SELECT k, min(section) AS first, max(section) AS last FROM s WHERE kind = 'own' AND NOT EXISTS (FROM s o WHERE o.k = s.k AND o.kind = 'edited' AND o.digest = s.digest) GROUP BY k),
dp AS (SELECT k, section, line FROM c WHERE kind = 'own' AND NOT EXISTS (FROM c o WHERE o.k = c.k AND o.kind = 'edited' AND o.digest = c.digest)),
b AS (
  SELECT ds.k, coalesce((SELECT min(line) FROM dp WHERE dp.k = ds.k AND dp.section = ds.first), (SELECT min(line) FROM c WHERE c.kind = 'own' AND c.k = ds.k AND c.section = ds.first)) AS first_edit,
         coalesce((SELECT max(line) FROM dp WHERE dp.k = ds.k AND dp.section = ds.last), (SELECT max(line) FROM c WHERE c.kind = 'own' AND c.k = ds.k AND c.section = ds.last)) AS last_edit
  FROM ds)
SELECT x.doc_id, x.n AS n_chars, sha256(x.edited) AS edited_sha256, ro.root AS fingerprint, re.root AS edited_fingerprint, ne.near AS near_edited, nn.near AS near_next,
       b.first_edit::INTEGER AS first_edit, b.last_edit::INTEGER AS last_edit
FROM x JOIN r ro ON ro.k = x.k AND ro.kind = 'own' JOIN r re ON re.k = x.k AND re.kind = 'edited'
JOIN near ne ON ne.k = x.k AND ne.kind = 'edited' JOIN near nn ON nn.k = x.k AND nn.kind = 'next' LEFT JOIN b ON b.k = x.k
"""
