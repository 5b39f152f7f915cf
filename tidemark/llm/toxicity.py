"""Toxicity: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

The lexicon is a short list of insults and what the labelled sample adds: words, and beginnings of
words, that toxic documents hold far more often than others. Near copies count once there, so that
a text copied many times doesn't fill the lexicon with its own words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text_stats as ts
from tidemark.llm.common import Scratch, numbered, slices, table
from tidemark.llm.line_crf import fold, labelled_sample

SAMPLE = 12_000  # labelled documents that lexicon and trees are fitted on, at most
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
TERMS = 4000  # of the lexicon, at most
BEGINNING = 5  # letters of a word's beginning
NEAR = 5  # words between an insult and a second person
TREES, DEPTH = 15, 3

# Insults, second-person words of four languages, and characters that stand for letters.
INSULTS = ("idiot", "moron", "loser", "scum", "trash", "stupid", "worthless", "pathetic", "disgusting", "clown", "imbecile", "dumb", "retard", "bastard", "vermin", "filth")
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te", "ton", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros")
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "€": "e"}

_LEXICON, _BEGINNING, _SECOND, _CAPS, _HIDDEN, _MIXED = 1, 2, 4, 8, 16, 32
_EDGES = re.compile(r"^[^\w@$]+|[^\w@$]+$")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_LONG = re.compile(r"(.)\1{2,}")
_STANDS = str.maketrans(STANDS_FOR)
REMEMBERED = 300_000
FEATURES = ("lexicon", "beginnings", "hidden", "lexicon_any", "beginnings_any", "hidden_any", "near_second_person", "second_person", "capitals", "capital_words", "punctuation", "exclamations", "symbols", "mixed_words", "size")


@dataclass
class Lexicon:
    words: frozenset[str]
    beginnings: frozenset[str]
    known: dict[str, int] = field(default_factory=dict)

    def _code(self, token: str) -> int:
        core = _EDGES.sub("", token)
        low = core.lower()
        plain = _NOT_LETTER.sub("", low)
        code = 0
        if low in self.words:
            code |= _LEXICON
        if len(plain) > BEGINNING and plain[:BEGINNING] in self.beginnings:
            code |= _BEGINNING
        if low in SECOND_PERSON:
            code |= _SECOND
        if len(core) >= 3 and core.isupper():
            code |= _CAPS
        if plain and plain != low:
            code |= _MIXED
            shown = {_NOT_LETTER.sub("", low.translate(_STANDS)), plain}
            shown |= {_LONG.sub(r"\1", x) for x in shown}
            if shown & self.words:
                code |= _HIDDEN
        elif low not in self.words and _LONG.search(low) and _LONG.sub(r"\1", low) in self.words:
            code |= _HIDDEN
        return code

    def codes(self, text: str) -> np.ndarray:
        """What each white-space token is, as bits."""
        known, tokens = self.known, text.split()
        out = list(map(known.get, tokens))
        if None in out:
            if len(known) > REMEMBERED:
                known.clear()
            for k, (t, c) in enumerate(zip(tokens, out, strict=True)):
                if c is None:
                    known[t] = out[k] = self._code(t)
        return np.array(out, dtype=np.int64)

    def features(self, texts: list[str]) -> np.ndarray:
        """A row of FEATURES for each text."""
        joined = "\n".join([*texts, ""])
        bits = ts.classes(joined)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        starts, ends = first[:-1], first[1:] - 1
        count = lambda flag: ts.sums(bits & flag > 0, starts, ends)
        letters = np.maximum(count(ts.UPPER | ts.LOWER), 1)
        chars = np.maximum(ends - starts, 1)
        shares = (count(ts.UPPER) / letters, count(ts.PUNCT) / chars, count(ts.EXCLAIM) / chars, count(ts.SYMBOL) / chars)
        out = np.zeros((len(texts), len(FEATURES)))
        for k, text in enumerate(texts):
            codes = self.codes(text)
            n = max(1, len(codes))
            hits = [int((codes & b > 0).sum()) for b in (_LEXICON, _BEGINNING, _HIDDEN, _SECOND, _CAPS, _MIXED)]
            insult, second = np.flatnonzero(codes & (_LEXICON | _BEGINNING | _HIDDEN)), np.flatnonzero(codes & _SECOND)
            near = 0
            if len(insult) and len(second):
                at = np.searchsorted(second, insult)
                after = second[np.minimum(at, len(second) - 1)] - insult
                before = insult - second[np.maximum(at - 1, 0)]
                near = int((((after >= 0) & (after <= NEAR)) | ((before >= 0) & (before <= NEAR))).sum())
            out[k] = (hits[0] / n, hits[1] / n, hits[2] / n, min(hits[0], 5), min(hits[1], 5), min(hits[2], 5), near / n, hits[3] / n, shares[0][k], hits[4] / n, shares[1][k], shares[2][k], shares[3][k], hits[5] / n, np.log1p(n))
        return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's different words and beginnings."""
    for batch in slices(batches):
        terms, labels = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = {_EDGES.sub("", t).lower() for t in set((text or "").split())}
            plain = {_NOT_LETTER.sub("", w) for w in words}
            own = {w for w in words if 2 < len(w) <= 40} | {p[:BEGINNING] + "*" for p in plain if len(p) > BEGINNING}
            terms += own
            labels += [label] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.int32())], names=["term", "label"])


def _signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of three words in a row, which near copies mostly share."""
    from xxhash import xxh3_64_intdigest

    for batch in slices(batches):
        out = []
        for text in batch.column("text").to_pylist():
            w = (text or "").encode().split()
            out.append(min((xxh3_64_intdigest(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))), default=0) >> 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "signature"])


def mine_lexicon(sample: DataFrame) -> Lexicon:
    """Words and beginnings that set toxic documents of the sample apart, at most TERMS in all."""
    signed = sample.mapInArrow(_signature, "doc_id long, text string, label int, signature long")
    once = signed.groupBy("signature", "label").agg(F.min_by("text", "doc_id").alias("text"))
    counted = once.select("text", "label").mapInArrow(_terms, "term string, label int")
    sums = counted.groupBy("term").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).where("t >= 4 and t >= 4 * c")
    total = once.agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).first()
    t, c = total["t"] or 0, total["c"] or 0
    odds = F.log((F.col("t") + 0.5) / (t - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (c - F.col("c") + 0.5))
    z = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    found = [r["term"] for r in sums.withColumn("z", z).where("z >= 3").orderBy(F.desc("z"), "term").limit(TERMS).collect()]
    words = frozenset(INSULTS) | {x for x in found if not x.endswith("*")}
    return Lexicon(words, frozenset(x[:-1] for x in found if x.endswith("*")))


def _features(words: frozenset[str], beginnings: frozenset[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(words, beginnings)
        for batch in slices(batches):
            rows = lexicon.features([t or "" for t in batch.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names), pa.array(list(rows), pa.list_(pa.float64()))], names=[*batch.schema.names, "_features"])

    return run


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def calibration(raw: DataFrame) -> IsotonicRegressionModel:
    """The non-decreasing step from raw probabilities to shares of label 1 that is nearest to `raw` (raw, label)."""
    return IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(raw)


def score_toxicity(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with `score` (0 to 1) for every row; columns of docs stay, whatever their names, but for one named score.

    Lexicon, trees and calibration are fitted on at most `sample` labelled documents outside the
    held-out fold (three tenths of them calibrate). Null and empty texts score as texts without
    words. Labels that are null or not 0 or 1 are not used; of repeated labels the larger counts. If
    a class is missing in one of the two parts, the whole sample serves for both; if it has no
    example at all, nothing can be told apart and every score is 0.
    """
    kept = docs.drop("score")
    own, names, back = numbered(kept)
    text = names[kept.columns.index(text_col)]
    rows = scratch.save(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, sample, id_col, text_col).select("doc_id", "text", "label"), "sample")
    lexicon = mine_lexicon(rows)
    run = _features(lexicon.words, lexicon.beginnings, "text")
    fitted = rows.mapInArrow(run, f"{_ddl(rows)}, _features array<double>").select("doc_id", F.col("label").cast("double").alias("label"), array_to_vector("_features").alias("features"))
    fitted = scratch.save(fitted.coalesce(4), "fitted")
    scratch.drop("sample")
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)) < 3
    learns = ~calibrates
    classes = {(r["c"], int(r["label"])): r["n"] for r in fitted.groupBy(calibrates.alias("c"), "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    featured = own.mapInArrow(_features(lexicon.words, lexicon.beginnings, text), f"{_ddl(own)}, _features array<double>")
    if len({y for _, y in classes}) < 2:
        return kept.withColumn("score", F.lit(0.0))
    if len(classes) < 4:
        learns = calibrates = F.lit(True)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=7, cacheNodeIds=False).fit(fitted.where(learns))
    probability = vector_to_array("probability")[1]
    raw = trees.transform(fitted.where(calibrates)).select("label", probability.alias("raw"))
    curve = calibration(raw)
    scored = trees.transform(featured.withColumn("features", array_to_vector("_features"))).withColumn("raw", probability)
    return curve.transform(scored).select(*back, F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, labels, Scratch(spark, "toxicity"))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
