"""How the sources of a language differ in their words, by ranking count cells instead of terms.

A term's share in a source and in its language depends on its two counts alone, so terms are grouped
into cells of (count in the source, count in the language), and the measure is taken once a cell.
Cells of equal value are one class; classes are ranked with the number of terms in those before
them, and only the classes that reach into the top are expanded to terms, in order of UTF-8 bytes.
Sources are compared two at a time over all terms of the language, as matrices of shares.
All arithmetic is on integers: a share is 1 + floor(10**9 * (count + 5) / (N + 5 * V)).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import Scratch, slices, table

LEAST = 30  # documents of a language that must have a term
PRIOR = 5
TOP = 50
#: A byte of a term is itself, A-Z lower-cased, any other is a space: letters and all bytes beyond ASCII make terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PIECE, _ENTRIES = 1 << 20, 400_000  # bytes of a text that are split at once; entries that a task holds

_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def text_terms(data: bytes) -> Counter:
    """The terms of a text in UTF-8 and how often each occurs."""
    spaced, found, at = data.translate(_TERM_BYTES), Counter(), 0
    while at < len(spaced):
        to = spaced.find(b" ", at + _PIECE)
        to = len(spaced) if to < 0 else to
        found.update(spaced[at:to].split())
        at = to
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: for a term its occurrences and documents in a language and source; for a null term the documents alone."""
    totals: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in totals.items():
            own = docs[lang, source]
            terms = [None, *(t.decode("utf-8", "replace") for t in counts)]
            n, seen = [0, *counts.values()], [own[None], *(own[t] for t in counts)]
            columns = ([lang] * len(n), [source] * len(n), terms, n, seen)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COUNTED.types, strict=True)], schema=_COUNTED)
        totals.clear()
        docs.clear()

    held = 0
    for batch in slices(batches):
        for lang, source, data in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            found = text_terms(data)
            if (lang, source) not in totals:
                totals[lang, source], docs[lang, source] = Counter(), Counter()
            held -= len(totals[lang, source])
            totals[lang, source].update(found)
            docs[lang, source].update(found.keys())
            docs[lang, source][None] += 1
            held += len(totals[lang, source])
        if held > _ENTRIES:
            yield from told()
            held = 0
    yield from told()


def share(count: Column, of: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + PRIOR) / (of + PRIOR * terms)) by long division, three digits at a time, so that nothing passes 64 bits."""
    whole = of + PRIOR * terms
    steps = F.array(F.lit(0), F.lit(0), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("q"), (count + PRIOR).alias("r"))

    def step(x: Column, _: Column) -> Column:
        return F.struct((x["q"] * 1000 + F.floor(_div(x["r"] * 1000, whole))).alias("q"), (x["r"] * 1000 % whole).alias("r"))

    return F.aggregate(steps, start, step)["q"] + 1


def _div(a: Column, b: Column) -> Column:
    """a div b on integers, for non-negative a and positive b."""
    return F.call_function("div", a, b)


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same on arrays; whole is of + PRIOR * terms."""
    out, rest = np.zeros(counts.shape, dtype=np.int64), counts + PRIOR
    for _ in range(3):
        part, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + part
    return out + 1


_PAIRS = "lang string, source string, item string, value long"
_PAIR_TYPES = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over a task's terms, for any two sources of a language."""
    names: dict[str, list[str]] = {}
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        of = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in dict.fromkeys(of.tolist()):
            rows = batch.take(pa.array(np.flatnonzero(of == lang)))
            listed = rows.column("sources")[0].as_py()
            names.setdefault(lang, [x["source"] for x in listed])
            size = len(names[lang])
            total = sums.setdefault(lang, np.zeros((size, size), dtype=np.int64))
            place = {s: k for k, s in enumerate(names[lang])}
            whole = np.array([x["n"] for x in listed], dtype=np.int64) + PRIOR * rows.column("terms")[0].as_py()
            step = max(1, (1 << 20) // size)
            for at in range(0, rows.num_rows, step):
                by = rows.column("by").slice(at, step).to_pylist()
                counts = np.zeros((len(by), size), dtype=np.int64)
                for k, own in enumerate(by):
                    for x in own:
                        counts[k, place[x["source"]]] = x["n"]
                p = shares(counts, whole)
                for s in range(size):
                    total[s] += np.abs(p - p[:, s : s + 1]).sum(axis=0)
    for lang, total in sums.items():
        for s, source in enumerate(names[lang]):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(total)), pa.array([source] * len(total)), pa.array(names[lang]), pa.array(total[s])], schema=_PAIR_TYPES)


def audit(docs: DataFrame, scratch: Scratch, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: for each source of each language, its distances to the language's others and the terms that it has most too many of.

    Null texts, languages and sources are ''. A language keeps the terms that `least` of its
    documents have. Part `pair`: every other source, by the sum of |p - q| over all kept terms (0 if
    none is kept). Part `term`: the kept terms that the source has and whose share is above the
    language's, by the difference, ranks to `top`. Ranks go by falling value, then by the item's
    UTF-8 bytes. An empty table gives no row; further columns are not read. Sources of one language
    must be few enough for a task to hold a number for any two of them, as the result itself does.
    """
    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col))
    read = docs.select(lang.alias("lang"), source.alias("source"), text.cast("binary").alias("text"))
    partial = read.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counted = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by = F.collect_list(F.struct("source", "n"))
    terms = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), by.alias("by"))
    kept = scratch.save(terms.where((F.col("docs") >= least) | F.col("term").isNull()).drop("docs"), "terms")
    # Every language has a row for the null term, with all its sources.
    words = kept.where(F.col("term").isNotNull())
    of_source = words.select("lang", "term", "total", F.inline("by"))
    sizes = kept.groupBy("lang").agg(F.count("term").alias("terms"), F.sum("total").alias("of_lang"))
    here = kept.select("lang", F.inline("by")).groupBy("lang", "source").agg(F.sum("n").alias("of_source"))
    groups = scratch.save(here.join(sizes, "lang"), "groups")
    lists = groups.groupBy("lang", "terms").agg(F.array_sort(F.collect_list(F.struct("source", F.col("of_source").alias("n")))).alias("sources"))
    lists = scratch.save(lists, "sources")

    # Pairs of sources.
    summed = words.join(lists, "lang").select("lang", "by", "terms", "sources").mapInArrow(_distances, _PAIRS)
    summed = summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.join(lists.select("lang", "sources"), "lang").select("lang", "source", F.explode("sources.source").alias("item")).where("source <> item")
    pairs = pairs.join(summed, ["lang", "source", "item"], "left").withColumns({"part": F.lit("pair"), "value": F.coalesce("value", F.lit(0).cast("long"))})

    # Terms, by cells.
    cells = of_source.where("n > 0").groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("members"))
    p, q = share(F.col("n"), F.col("of_source"), F.col("terms")), share(F.col("total"), F.col("of_lang"), F.col("terms"))
    valued = cells.join(groups, ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q").select("lang", "source", "n", "total", "members", (F.col("p") - F.col("q")).alias("value"))
    valued = scratch.save(valued, "cells")
    group = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    classes = valued.groupBy("lang", "source", "value").agg(F.sum("members").alias("members"))
    classes = classes.withColumn("k", F.row_number().over(group)).where(F.col("k") <= top)  # each has a term at least
    reaching = classes.withColumn("before", F.sum("members").over(group.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("members")).where(F.col("before") < top)
    best = valued.join(reaching.select("lang", "source", "value"), ["lang", "source", "value"]).drop("members")
    items = of_source.join(best, ["lang", "source", "n", "total"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    group = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(group)) for x in (pairs, items)]
    columns = ("lang", "source", "part", "item", "value", "rank")
    return ranked[0].select(*columns).unionByName(ranked[1].where(F.col("rank") <= top).select(*columns))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(table(spark, sf_dir, "documents", "text", "lang", "source"), Scratch(spark, "divergence"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         (1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 5) // (coalesce(n.n, 0) + 5 * v.v))::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.total + 5) // (v.n + 5 * v.v))::BIGINT AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
items AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM items))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""
