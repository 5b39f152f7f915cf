"""Quality rules by robust multivariate outliers: minimum covariance determinant for each language and source.

Every document is a vector of transformed statistics. In each group, location and scatter start from
medians and absolute deviations, and once more from the signs about the medians. Each concentration
step takes the share COVER of the group's documents that lie nearest in Mahalanobis distance and
estimates both anew. A step counts if it lowers the group's determinant; steps go on until no group's
falls any more, and the start with the lesser determinant is taken. The nearest are cut at a
percentile whose rank is off by at most 1/ACCURACY of the group, so that two steps' subsets may
differ in size by as much; small groups are cut exactly.

A statistic that has one value in the share COVER of a group has no scatter there and takes no part
in these steps (where none has any, all do). A last, reweighted estimate over all statistics rests on the documents within the
share INLIERS of a normal group, and the distances of just these set the group's cutoff. In it, a
statistic that varies less than counting itself does (the root of a count has variance 1/4) takes
that variance, found from the same documents' sizes; others are left as they are.

Steps are aggregations over all documents of all groups at once, so a large group is summed in parts
and nothing but a few hundred numbers for each group moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text_stats as ts
from tidemark.llm.common import Scratch, slices, table
from tidemark.llm.tails import chi2_quantile, chi2_tail

NAMES = ("size", "word_length", "symbols", "dup_lines", "repeats", "punctuation", "capitals")
P = len(NAMES)
COVER = 0.75
FALLS = 1e-3  # by which a step's log determinant has to be less
ACCURACY = 2000  # of percentiles
LEAST = 2 * P + 1  # documents without which a group can have no estimate; smaller ones are pooled
REJECT = 1e-6  # share of a normal group that lies beyond the cutoff
INLIERS = 0.99  # share of a normal group that the reweighted estimate rests on
#: For each statistic how its counting varies: over words, characters, lines or letters.
_NOISE = ("inv_words", "inv_words", "inv_chars / 4", "inv_lines / 4", "inv_words / 4", "inv_chars / 4", "inv_letters / 4")
_INVERSE = ("inv_words", "inv_chars", "inv_lines", "inv_letters")

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that are found twice or more, all of them included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=n).view(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    rolled = h[: n - WINDOW + 1].copy()
    for k in range(1, WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k : n - WINDOW + 1 + k]
    order = np.argsort(rolled, kind="stable")
    equal = np.diff(rolled[order]) == 0
    twice = np.zeros(len(rolled), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[: len(twice)] += twice
    edge[WINDOW:] -= twice
    return int((np.cumsum(edge[:n]) > 0).sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines)), len(lines)


def base_counts(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and lines with a word."""
    words = text.encode("utf-8", "surrogatepass").split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    dup, lines = duplicate_lines(text)
    return len(words), len(text) - spaces, len(text) - len(text.translate(_SYMBOLS)), dup, repeated_words(words), lines


def _statistics(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            base = np.array([base_counts(t) for t in texts], dtype=np.int64).reshape(-1, 6)
            bits = ts.classes("\n".join([*texts, ""]))
            first = np.cumsum([0, *(len(t) + 1 for t in texts)])
            count = lambda flag: ts.sums(bits & flag > 0, first[:-1], first[1:] - 1)
            words, chars, lines = np.maximum(base[:, 0], 1), np.maximum(base[:, 1], 1), np.maximum(base[:, 5], 1)
            letters = np.maximum(count(ts.UPPER | ts.LOWER), 1)
            x = (np.log1p(base[:, 0]), np.log(chars / words), np.sqrt(base[:, 2] / chars), np.sqrt(base[:, 3] / lines), np.sqrt(base[:, 4] / words), np.sqrt(count(ts.PUNCT) / chars), np.sqrt(count(ts.UPPER) / letters))
            x = (*x, 1 / words, 1 / chars, 1 / lines, 1 / letters)
            columns = [batch.column(n) for n in batch.schema.names if n != text_col]
            names = [n for n in batch.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(base[:, k]) for k in range(5)), *(pa.array(v) for v in x)], names=[*names, *(c.split()[0] for c in _BASE.split(", ")), *NAMES, *_INVERSE])

    return run


_GROUP = ["g_lang", "g_source"]
_MODEL = "g_lang string, g_source string, start int, live int, logdet double, was double, " + ", ".join([*(f"m{i} double" for i in range(P)), *(f"p{i}_{j} double" for i in range(P) for j in range(i, P))])


def _inverse(scatter: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse and log determinant; directions without scatter, in units of the statistics' own deviations, are lifted to a billionth."""
    unit = np.sqrt(np.maximum(np.diag(scatter), 1e-300))
    values, vectors = np.linalg.eigh(scatter / np.outer(unit, unit))
    values = np.maximum(values, 1e-9)
    return vectors / values @ vectors.T / np.outer(unit, unit), float(np.log(values).sum() + 2 * np.log(unit).sum())


def _model(rows: pd.DataFrame, reweighted: bool) -> pd.DataFrame:
    """Location and inverse scatter of each group from its sums: of its live statistics (bits of `live`), or of all if reweighted."""
    share = 1.0 if reweighted else (1 - chi2_tail(chi2_quantile(COVER, P), P + 2)) / COVER
    out = []
    for r in rows.itertuples(index=False):
        n = max(1, r.n)
        mean = np.array([getattr(r, f"s{i}") for i in range(P)]) / n
        scatter, inverse, logdet = np.zeros((P, P)), np.zeros((P, P)), 0.0
        for i in range(P):
            for j in range(i, P):
                scatter[i, j] = scatter[j, i] = getattr(r, f"s{i}_{j}") / n - mean[i] * mean[j]
        own = [i for i in range(P) if reweighted or not r.live or r.live >> i & 1]
        if reweighted or not r.live:
            noise = np.array([getattr(r, f"e{i}") for i in range(P)]) / n
            scatter += np.diag(np.maximum(0, noise - np.diag(scatter)))
        if own:
            inverse[np.ix_(own, own)], logdet = _inverse(scatter[np.ix_(own, own)] / share)
        out.append([r.g_lang, r.g_source, r.start, r.live, logdet, r.logdet, *mean, *(inverse[i, j] for i in range(P) for j in range(i, P))])
    return pd.DataFrame(out, columns=[c.split()[0] for c in _MODEL.split(", ")])


def _distance() -> str:
    centred = [f"({c} - m{i})" for i, c in enumerate(NAMES)]
    return " + ".join(f"{1 if i == j else 2} * p{i}_{j} * {centred[i]} * {centred[j]}" for i in range(P) for j in range(i, P))


def _products(columns: list[Column], name: str) -> list[Column]:
    return [F.sum(columns[i] * columns[j]).alias(f"{name}{i}_{j}") for i in range(P) for j in range(i, P)]


def _summed(near: DataFrame, reweighted: bool = False) -> DataFrame:
    """The model of the documents near."""
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)] + _products([F.col(c) for c in NAMES], "s")
    noise = [F.sum(F.expr(e)).alias(f"e{i}") for i, e in enumerate(_NOISE)]
    summed = near.groupBy(*_GROUP, "start", "live", "logdet").agg(F.count(F.lit(1)).alias("n"), *sums, *noise)
    return summed.mapInPandas(lambda parts: (_model(x, reweighted) for x in parts if len(x)), _MODEL)


class _Estimates:
    """Location and scatter of every group of `used` (its keys and statistics)."""

    def __init__(self, used: DataFrame, groups: int, scratch: Scratch):
        self.used, self.scratch = used, scratch
        self.files = -(-groups // 10_000) or 1

    def small(self, df: DataFrame, name: str) -> DataFrame:
        """A table with a row or two for each group, written: in as few files as its groups need, so that Spark sees how small it is and needn't deal the documents by group."""
        return self.scratch.save(df.repartition(self.files), name)

    def on_group(self, table: DataFrame, *keys: str) -> DataFrame:
        return self.used.join(table, [*_GROUP, *keys])

    def quantile(self, df: DataFrame, value: str, share: float, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
        return self.small(df.groupBy(*_GROUP, *keys).agg(F.percentile_approx(value, share, ACCURACY).alias(name)), name)

    def starts(self) -> DataFrame:
        """Two models for each group: deviations alone, and the signs' scatter about the medians in units of these deviations."""
        medians = self.small(self.used.groupBy(*_GROUP).agg(*(F.percentile_approx(c, 0.5, ACCURACY).alias(f"m{i}") for i, c in enumerate(NAMES))), "medians")
        apart = self.on_group(medians).groupBy(*_GROUP).agg(*(F.percentile_approx(F.abs(F.col(c) - F.col(f"m{i}")), COVER, ACCURACY).alias(f"d{i}") for i, c in enumerate(NAMES)))
        live = sum((F.when(F.col(f"d{i}") > 0, 1 << i).otherwise(0) for i in range(P)), F.lit(0)).cast("int")
        centre = self.small(medians.join(apart, _GROUP).withColumn("live", live), "centre")
        z = [F.when(F.col(f"d{i}") > 0, (F.col(c) - F.col(f"m{i}")) / F.col(f"d{i}")).otherwise(0.0) for i, c in enumerate(NAMES)]
        length = F.sqrt(sum((F.pow(F.col(f"z{i}"), 2) for i in range(P)), F.lit(0.0)))
        unit = self.on_group(centre).select(*_GROUP, *(x.alias(f"z{i}") for i, x in enumerate(z))).withColumn("length", length).where("length > 0")
        signs = unit.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"), *_products([F.col(f"z{i}") / F.col("length") for i in range(P)], "z"))
        return self.small(centre.join(signs, _GROUP, "left").mapInPandas(_started, _MODEL), "start").drop("was")

    def settled(self) -> DataFrame:
        """The model of least determinant of each group. Every step that goes on lowers a determinant by FALLS, so there is a last one."""
        model, done = self.starts(), []
        for step in count(1):
            far = self.on_group(model).withColumn("d2", F.expr(_distance())).select(*_GROUP, *NAMES, *_INVERSE, "start", "live", "logdet", "d2")
            reach = self.quantile(far, "d2", COVER, f"reach_{step}", ("start",)).withColumnRenamed(f"reach_{step}", "reach")
            new = self.small(_summed(far.join(reach, [*_GROUP, "start"]).where("d2 <= reach")), f"model-{step}")
            falls = F.col("was").isNull() | (F.col("logdet") < F.col("was") - FALLS)
            done.append(new.where(~falls).drop("was"))
            model = new.where(falls).drop("was")
            if not model.limit(1).count():
                break
        done = reduce(DataFrame.unionByName, done)
        best = done.groupBy(*_GROUP).agg(F.min_by(F.struct(*done.columns[2:]), F.struct("logdet", "start")).alias("best"))
        return self.small(best.select(*_GROUP, "best.*"), "settled")


def _started(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    normal = float(np.sqrt(chi2_quantile(COVER, 1)))  # deviation within which the share COVER of a normal statistic lies
    for rows in parts:
        out = []
        for r in rows.itertuples(index=False):
            own = [i for i in range(P) if not r.live or r.live >> i & 1]
            unit = np.array([getattr(r, f"d{i}") if r.live else 1.0 for i in own]) / normal
            signs = np.array([[getattr(r, f"z{min(i, j)}_{max(i, j)}") for j in own] for i in own], dtype=float).reshape(len(own), len(own))
            for start, scatter in enumerate((np.eye(len(own)), signs / max(1, r.n if r.n == r.n and r.n else 1) * max(1, len(own)))):
                if not np.isfinite(scatter).all():
                    continue
                inverse = np.zeros((P, P))
                if own:
                    inverse[np.ix_(own, own)] = _inverse(scatter * np.outer(unit, unit))[0]
                out.append([r.g_lang, r.g_source, start, r.live, None, None, *(getattr(r, f"m{i}") for i in range(P)), *(inverse[i, j] for i in range(P) for j in range(i, P))])
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _MODEL.split(", ")])


def judge(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept for every row.

    Only documents that pass the base rules are estimated from or judged by distance; all others are
    not kept. Groups of fewer than LEAST such documents, which can have no estimate, are pooled
    within their language, and pools as small over all languages; a pool that is still smaller
    judges nothing (distance null). Null languages and sources are values like others. Null texts
    have no words. Repeated rows count as often as they come; further columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit("")).alias("lang"), F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"))
    stats = source.mapInArrow(_statistics("text"), f"doc_id long, lang string, source string, {_BASE}, " + ", ".join(f"{c} double" for c in (*NAMES, *_INVERSE)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    stats = scratch.save(stats.withColumn("base_failed", failed), "statistics")

    counts = stats.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    groups = counts.withColumn("g_source", F.when(F.col("n") >= LEAST, F.col("source")).otherwise("*"))
    pools = groups.groupBy("lang", "g_source").agg(F.sum("n").alias("pool"))
    groups = groups.join(pools, ["lang", "g_source"]).withColumn("g_lang", F.when(F.col("pool") >= LEAST, F.col("lang")).otherwise("*"))
    groups = scratch.save(groups.select("lang", "source", "g_lang", "g_source", "n"), "groups")
    sizes = groups.groupBy(*_GROUP).agg(F.sum("n").alias("size_of_group"))
    grouped = scratch.save(stats.join(groups.drop("n").repartition(1 + groups.count() // 10_000), ["lang", "source"], "left").drop("lang", "source"), "grouped")
    used = grouped.where("not base_failed").select(*_GROUP, *NAMES, *_INVERSE)
    estimates = _Estimates(used, sizes.count(), scratch)
    model = estimates.settled()

    # The median distance gives the scale, as the steps' scatter is that of their nearest documents alone.
    far = estimates.on_group(model).withColumn("d2", F.expr(_distance())).select(*_GROUP, *NAMES, *_INVERSE, "start", "live", "logdet", "d2")
    middle = estimates.quantile(far, "d2", 0.5, "middle")
    wide = [chi2_quantile(INLIERS, p) / chi2_quantile(0.5, p) for p in [P, *range(1, P + 1)]]
    within = F.element_at(F.array(*map(F.lit, wide)), F.bit_count("live") + 1)
    inliers = far.join(middle, _GROUP).where(F.col("d2") <= F.col("middle") * within)
    model = estimates.small(_summed(inliers, reweighted=True).drop("start", "live", "logdet", "was"), "reweighted")
    inlying = inliers.select(*_GROUP, *NAMES).join(model, _GROUP).withColumn("d", F.sqrt(F.greatest(F.lit(0.0), F.expr(_distance()))))
    cutoff, tail = (float(np.sqrt(chi2_quantile(x, P))) for x in (1 - REJECT, INLIERS))
    edges = estimates.quantile(inlying, "d", INLIERS, "edge")
    cutoffs = edges.select(*_GROUP, (cutoff * F.greatest(F.lit(1.0), F.col("edge") / tail)).alias("cutoff"))
    judged = grouped.join(estimates.small(model.join(sizes, _GROUP).join(cutoffs, _GROUP), "final"), _GROUP, "left")
    scratch.keep("grouped", "final")
    distance = F.when(~F.col("base_failed") & (F.col("size_of_group") >= LEAST), F.sqrt(F.greatest(F.lit(0.0), F.expr(_distance()))))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.col("cutoff"), F.lit(True))
    return judged.withColumn("distance", distance).select("doc_id", *(c.split()[0] for c in _BASE.split(", ")), "base_failed", kept.alias("kept"), "distance")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by the base rules and by its distance."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return judge(docs, Scratch(spark, "outliers"))
