"""Quality from a linear-chain conditional random field that labels every line good or bad.

A line's features are its own shares of character classes, its size and whether it repeats an
earlier line, and the same of its two neighbours. Training starts from documents' labels on all
their lines; lines of bad documents that the first field holds to be good are then relabelled, and
the field is fitted again. Forward-backward marginals, weighted by line length, give a document's
share of good text, and a logistic curve fitted on the same sample makes it a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text_stats as ts
from tidemark.llm.common import slices, table

SAMPLE = 1500  # labelled documents that the field is fitted on, at most
LONGEST = 50_000  # characters of a text that the field is fitted on, at most
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
OWN = 14  # features of a line by itself
STEPS, RATE, RIDGE = 60, 0.3, 1e-4


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines, 3 * OWN + 1), each line's length, and how many lines each text has; blank lines are none."""
    joined = "\n".join([*texts, ""])
    bits = ts.classes(joined)
    breaks = np.flatnonzero(bits & ts.BREAK)
    starts, ends = np.concatenate(([0], breaks[:-1] + 1)), breaks
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    solid = (ends - starts) - ts.sums(bits & ts.SPACE > 0, starts, ends)
    starts, ends, solid = starts[solid > 0], ends[solid > 0], solid[solid > 0]
    doc = np.searchsorted(first, starts, "right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    n = len(starts)
    if not n:
        return np.zeros((0, 3 * OWN + 1)), np.zeros(0), counts
    share = lambda flag: ts.sums(bits & flag > 0, starts, ends) / solid
    space = bits & ts.SPACE > 0
    heads = np.concatenate(([True], space[:-1])) & ~space
    words = np.maximum(ts.sums(heads, starts, ends), 1)
    letters = np.maximum(ts.sums(bits & (ts.UPPER | ts.LOWER) > 0, starts, ends), 1)
    upper = ts.sums(bits & ts.UPPER > 0, starts, ends)
    seen: dict[tuple[int, int], int] = {}
    repeats, spread = np.zeros(n), np.zeros(n)
    for k, (d, a, b) in enumerate(zip(doc.tolist(), starts.tolist(), ends.tolist(), strict=True)):
        line = joined[a:b]
        key = (d, hash(line))
        repeats[k] = key in seen
        seen[key] = 1
        own = line.split()
        spread[k] = 1 - len(set(own)) / max(1, len(own)) if len(own) >= 20 else 0.0
    f = np.stack([np.minimum(np.log1p(solid) / 8, 1.5), share(ts.SYMBOL), upper / letters, share(ts.DIGIT), share(ts.PUNCT), share(ts.EXCLAIM), share(ts.PIPE), share(ts.STOP), np.minimum(solid / words / 20, 2), 1 - letters / solid, repeats, spread, words < 4, upper > 0.8 * letters], axis=1).astype(np.float64)
    f[:, 1:8] = np.minimum(1, np.sqrt(f[:, 1:8]) * 1.5)
    same = np.concatenate((doc[1:] == doc[:-1], [False]))
    after, before = np.zeros_like(f), np.zeros_like(f)
    after[:-1][same[:-1]] = f[1:][same[:-1]]
    before[1:][same[:-1]] = f[:-1][same[:-1]]
    return np.concatenate([np.ones((n, 1)), f, before, after], axis=1), solid.astype(np.float64), counts


@dataclass
class Field:
    """emit: weights (features, 2) for bad and good; move: (2, 2) for label pairs; curve: of the logistic."""

    emit: np.ndarray
    move: np.ndarray
    curve: tuple[float, float] = (1.0, 0.0)

    def marginals(self, features: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(label) for every line, expected label pairs, and the log of all partition functions together."""
        score = features @ self.emit
        counts = counts[counts > 0]
        if not len(counts):
            return np.zeros((0, 2)), np.zeros((2, 2)), 0.0
        firsts = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")  # so that the texts with a k-th line come first
        counts, firsts = counts[order], firsts[order]
        left = np.searchsorted(-counts, -np.arange(counts[0]), "left")  # texts with more than k lines
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[firsts] = score[firsts]
        for k in range(1, int(counts[0])):
            at = firsts[: left[k]] + k
            alpha[at] = score[at] + np.logaddexp(alpha[at - 1, :1] + self.move[0], alpha[at - 1, 1:] + self.move[1])
        for k in range(int(counts[0]) - 1, 0, -1):
            at = firsts[: left[k]] + k
            onward = score[at] + beta[at]
            beta[at - 1] = np.logaddexp(onward[:, :1] + self.move[:, 0], onward[:, 1:] + self.move[:, 1])
        last = firsts + counts - 1
        z = np.logaddexp(alpha[last, 0], alpha[last, 1])
        back = np.argsort(order)
        total = np.repeat(z[back], counts[back])
        p = np.exp(alpha + beta - total[:, None])
        inner = np.ones(len(score), dtype=bool)
        inner[firsts] = False
        to = np.flatnonzero(inner)
        pair = np.exp(alpha[to - 1][:, :, None] + self.move + (score[to] + beta[to])[:, None, :] - total[to][:, None, None]).sum(axis=0)
        return p, pair, float(z.sum())

    def good_share(self, features: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted share of good text; 0 for a text without lines."""
        p, _, _ = self.marginals(features, counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        weight = np.bincount(doc, weights=size, minlength=len(counts))
        good = np.bincount(doc, weights=size * p[:, 1], minlength=len(counts)) if len(size) else np.zeros(len(counts))
        return good / np.maximum(weight, 1)

    def score(self, texts: list[str]) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-(a * self.good_share(*line_features(texts)) + b)))


def _fit_field(features: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Field:
    """Maximum likelihood by Adam, all lines at once."""
    field = Field(np.zeros((features.shape[1], 2)), np.zeros((2, 2)))
    wanted = np.zeros((len(labels), 2))
    wanted[np.arange(len(labels)), labels] = 1
    doc = np.repeat(np.arange(len(counts)), counts)
    same = doc[1:] == doc[:-1]
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (labels[:-1][same], labels[1:][same]), 1)
    n, state = len(labels), [np.zeros_like(x) for x in (field.emit, field.emit, field.move, field.move)]
    for step in range(1, STEPS + 1):
        p, pair, _ = field.marginals(features, counts)
        grads = (features.T @ (p - wanted) / n + RIDGE * field.emit, (pair - pairs) / n + RIDGE * field.move)
        for k, (x, g) in enumerate(zip((field.emit, field.move), grads, strict=True)):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * g
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * g * g
            x -= RATE * (state[2 * k] / (1 - 0.9**step)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
    return field


def _fit_curve(share: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of one variable by Newton steps, lightly held to the origin."""
    x, w = np.stack([share, np.ones_like(share)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = x.T @ (p - label) + 0.01 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(texts: list[str], labels: list[int]) -> Field:
    """A field from whole texts and their 0/1 labels; without texts one that holds everything to be good."""
    y = np.array(labels, dtype=np.int64)
    features, size, counts = line_features(texts)
    if not len(features) or y.min() == y.max():
        good = 1.0 if not len(y) else float(y[0])
        return Field(np.zeros((3 * OWN + 1, 2)), np.zeros((2, 2)), (0.0, 4.0 * (2 * good - 1)))
    of_doc = np.repeat(y, counts)
    field = _fit_field(features, counts, of_doc)
    p, _, _ = field.marginals(features, counts)
    relabelled = np.where((of_doc == 0) & (p[:, 1] > 0.5), 1, of_doc)
    doc = np.repeat(np.arange(len(counts)), counts)
    some_bad = np.bincount(doc, weights=relabelled == 0, minlength=len(counts)) > 0
    relabelled = np.where(some_bad[doc], relabelled, of_doc)  # a bad document keeps bad lines
    if relabelled.min() != relabelled.max():
        field = _fit_field(features, counts, relabelled)
    field.curve = _fit_curve(field.good_share(features, size, counts), y)
    return field


def fold(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    """The fold of a document, from the CRC-32 of its id as text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, label of at most `most` documents with a label (in labels: doc_id and it) outside the held-out fold, those with the smallest hashes.

    However many rows share a doc_id, it comes once, with the least of their texts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = source.join(F.broadcast(chosen), "doc_id")  # at most `most` rows
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def _score(field: Field, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            scores = field.score([t or "" for t in batch.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' id and text columns with score (0 to 1), for every row.

    The field is fitted on at most `sample` labelled documents outside the held-out fold, which
    the driver holds, none of them of more than LONGEST characters; all else is scored where it lies. Null and empty texts have no good text.
    Labels that are null or not 0 or 1 are not used; of repeated labels the larger counts.
    """
    rows = labelled_sample(docs.where(F.coalesce(F.length(text_col), F.lit(0)) <= LONGEST), labels, "quality", FOLDS, HELD_OUT, sample, id_col, text_col).orderBy("doc_id", "text").toPandas()
    field = train([t or "" for t in rows["text"]], rows["label"].tolist())
    own = docs.select(id_col, text_col)
    return own.mapInArrow(_score(field, text_col), f"`{id_col}` {own.schema[id_col].dataType.simpleString()}, `{text_col}` string, score double")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = score_quality(docs, labels)
    return scored.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
