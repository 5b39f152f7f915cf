"""Secret scans: fixed patterns, and a battery of randomness tests over the other long runs of key characters.

A run's encoding is inferred from its characters. Under "random in that encoding" three tests give
p-values: chi-squared uniformity of the alphabet in eight bins, Wald-Wolfowitz runs about the
alphabet's middle, and lag-one serial correlation; Fisher's method combines them, and a run that
fails is not random. For one that passes, the likelihood ratio of "random" against "ordinary"
(characters that mostly stay within their class, or words with capitals that are run together, each
with half the weight) bounds the p-value of "ordinary" by 1 / ratio; it falls with length by itself. Benjamini-Hochberg over all runs of the corpus, in bands of length,
decides which are reported, from a histogram of the p-values.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, numbered, slices, table
from tidemark.llm.tails import chi2_tail, normal_tail

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_RUN = 6, 20, 24, 20

FALSE_DISCOVERIES = 0.01  # share of reported runs that may be ordinary
RANDOM_LEVEL = 0.001  # p-value below which a run fails the battery
BANDS = (32, 64)  # run lengths at which a new band begins
_STAY = 0.95  # chance that an ordinary character has its predecessor's class
#: Of run-together words: chances that upper, lower, digit and other are followed by each of these.
_CAMEL = ((0.03, 0.93, 0.02, 0.02), (0.14, 0.83, 0.015, 0.015), (0.1, 0.1, 0.7, 0.1), (0.45, 0.45, 0.05, 0.05))
LEVELS_PER_10 = 20  # steps of the histogram for each power of ten

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Alphabets in the order of their codes.
_ALPHABETS = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": _UPPER + "234567", "lower": _LOWER, "upper": _UPPER, "lower36": _DIGIT + _LOWER, "upper36": _DIGIT + _UPPER, "base62": _UPPER + _LOWER + _DIGIT, "base64": _UPPER + _LOWER + _DIGIT + "+/", "base64url": _UPPER + _LOWER + _DIGIT + "-_", "any": _UPPER + _LOWER + _DIGIT + "+/-_"}


def _char_table() -> np.ndarray:
    table = np.zeros(128, dtype=np.uint8)
    for c in _ALPHABETS["any"]:
        table[ord(c)] |= 2
    for c in _ALPHABETS["hex"]:
        table[ord(c)] |= 1
    return table


_TABLE = _char_table()


def infer_encoding(run: str) -> str | None:
    """The smallest alphabet that holds the run; None for plain numbers."""
    used = set(run)
    if used <= set(_DIGIT):
        return None
    return min((k for k, a in _ALPHABETS.items() if used <= set(a)), key=lambda k: len(_ALPHABETS[k]))


def battery(codes: np.ndarray, size: int) -> float:
    """Combined p-value of "uniform and independent over an alphabet of this size"."""
    n = len(codes)
    bins = np.bincount(codes * 8 // size, minlength=8)
    expected = n * np.bincount(np.arange(size) * 8 // size, minlength=8) / size
    p = [chi2_tail(float(((bins - expected) ** 2 / expected).sum()), 7)]
    high = codes * 2 >= size
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        runs, mean = 1 + int((high[1:] != high[:-1]).sum()), 1 + 2 * a * b / n
        spread = math.sqrt(max(1e-9, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))))
        p.append(normal_tail((runs - mean) / spread))
    else:
        p.append(2.0 ** (1 - n))
    centred = codes - codes.mean()
    var = float((centred**2).sum())
    p.append(normal_tail((float((centred[1:] * centred[:-1]).sum()) / var + 1 / n) * math.sqrt(n)) if var else 0.0)
    return chi2_tail(-2 * sum(math.log(max(x, 1e-300)) for x in p), 2 * len(p))


def ordinary_level(run: str) -> int:
    """Of the p-value of "ordinary", the steps below 1 in the histogram; 0 for a run that fails the battery."""
    name = infer_encoding(run)
    if name is None:
        return 0
    alphabet = _ALPHABETS[name]
    place = {c: k for k, c in enumerate(alphabet)}
    if battery(np.array([place[c] for c in run]), len(alphabet)) < RANDOM_LEVEL:
        return 0
    kinds = [0 if c in _UPPER else 1 if c in _LOWER else 2 if c in _DIGIT else 3 for c in run]
    steps = list(zip(kinds, kinds[1:], strict=False))
    staying = sum(math.log(_STAY if a == b else (1 - _STAY) / 3) for a, b in steps)
    joined = sum(math.log(_CAMEL[a][b]) for a, b in steps)
    ordinary = sum(math.log((1 / 26, 1 / 26, 1 / 10, 1 / 4)[k]) for k in kinds) + float(np.logaddexp(staying, joined)) - math.log(2)
    ratio = -len(run) * math.log(len(alphabet)) - ordinary
    return max(0, min(int(ratio / math.log(10) * LEVELS_PER_10), 40 * LEVELS_PER_10))


def _runs(flags: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of at least so many set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def scan(texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int, int]]]]:
    """For each text its base spans (start, kind, end) and the runs outside of them (start, end, level, band)."""
    base: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    other: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    for k, t in enumerate(texts):
        low = t.lower()
        if any(w in low for w in _ASSIGN_WORDS):
            base[k] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= LEAST_VALUE]
        if "AKIA" in t:
            base[k] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if m.end() - m.start() >= LEAST_ACCESS]
    chars = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    flags = np.zeros(len(chars), dtype=np.uint8)
    ascii_ = chars < 128
    flags[ascii_] = _TABLE[chars[ascii_]]
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, ends = _runs((flags & 1).astype(bool), LEAST_HEX)
    for k, a, b in zip((np.searchsorted(first, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist(), strict=True):
        base[k].append((a - int(first[k]), 2, b - int(first[k])))
    for k, spans in enumerate(base):
        for x, _, y in spans:
            flags[first[k] + x : first[k] + y] = 0  # what is left of a run on either side is tested by itself
    starts, ends = _runs((flags & 2).astype(bool), LEAST_RUN)
    for k, a, b in zip((np.searchsorted(first, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist(), strict=True):
        a, b = a - int(first[k]), b - int(first[k])
        other[k].append((a, b, ordinary_level(texts[k][a:b]), sum(b - a >= x for x in BANDS)))
    return [sorted(x) for x in base], other


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_FOUND = f"secret_base {_SPANS}, secret_runs array<struct<start:int,end:int,level:int,band:int>>"


def _scan(text_col: str):
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("level", pa.int32()), ("band", pa.int32())]))

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, other = scan([t or "" for t in batch.column(text_col).to_pylist()])
            found = [pa.array([[dict(zip(("start", "kind", "end"), x, strict=True)) for x in xs] for xs in base], span), pa.array([[dict(zip(("start", "end", "level", "band"), x, strict=True)) for x in xs] for xs in other], run)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "secret_base", "secret_runs"])

    return run_


def least_levels(histogram: dict[tuple[int, int], int], share: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """For each band the lowest level that Benjamini-Hochberg reports, if any; levels round p-values up."""
    out = {}
    for band in {b for b, _ in histogram}:
        total, seen = sum(n for (b, _), n in histogram.items() if b == band), 0
        for level in sorted((x for b, x in histogram if b == band), reverse=True):
            seen += histogram[band, level]
            if level and 10 ** (-level / LEVELS_PER_10) <= share * seen / total:
                out[band] = level
    return out


def find_secrets(docs: DataFrame, scratch: Scratch, text_col: str = "text") -> DataFrame:
    """docs with `secret_base` and `secret_spans`: arrays of (start, kind, end), sorted; kind is a place in KINDS.

    Positions count code points, end exclusive. Null texts have no spans. Every column of docs
    stays, whatever its name (but ones of these two names and `secret_runs` are replaced); repeated rows stay.
    """
    spark = docs.sparkSession
    own = docs.drop("secret_base", "secret_runs", "secret_spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    found = scratch.save(own.mapInArrow(_scan(text_col), f"{fields}, {_FOUND}"), "found")
    each = found.select(F.explode("secret_runs").alias("r")).groupBy("r.band", "r.level").agg(F.count(F.lit(1)).alias("n"))
    least = least_levels({(r["band"], r["level"]): r["n"] for r in each.collect()})  # at most 3 bands of 801 levels
    test = " or ".join(f"(x.band = {b} and x.level >= {v})" for b, v in sorted(least.items())) or "false"
    added = F.expr(f"transform(filter(secret_runs, x -> {test}), x -> named_struct('start', x.start, 'kind', {KINDS.index('random')}, 'end', x.end))")
    return found.withColumn("secret_spans", F.array_sort(F.concat("secret_base", added))).drop("secret_runs")


def joined(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at({names}, x.kind + 1), ':', x.start, ':', x.end)), ',')")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    counts = [F.expr(f"cast(size(filter(secret_base, x -> x.kind = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return found.select(id_col, *counts, F.sha2(joined("secret_base").cast("binary"), 256).alias("base_sha256"), joined("secret_spans").alias("spans"))


def _redact(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text, spans in zip(batch.column(text_col).to_pylist(), batch.column("secret_spans").to_pylist(), strict=True):
                if text and spans:
                    parts, at = [], 0
                    for s in spans:
                        if s["end"] > at:
                            parts += [text[at : max(at, s["start"])], f"[{KINDS[s['kind']]}]"] if s["start"] >= at else []
                            at = s["end"]
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            names = [n for n in batch.schema.names if n not in ("secret_base", "secret_spans")]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in names], names=names)

    return run


def redact(docs: DataFrame, scratch: Scratch, text_col: str = "text") -> DataFrame:
    """docs with every secret replaced by its kind in brackets; n_chars, if it is there, follows the new text."""
    own, names, back = numbered(docs)
    text = names[docs.columns.index(text_col)]
    found = find_secrets(own, scratch, text)
    out = found.mapInArrow(_redact(text), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields))
    if "n_chars" in docs.columns:
        out = out.withColumn(names[docs.columns.index("n_chars")], F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*back)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return digest(find_secrets(docs, Scratch(spark, "secrets")))
