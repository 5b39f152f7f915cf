"""What toxicity's features, lexicon and calibration are, by hand; what secret scans find and miss over encodings and lengths."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import TABLES  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import secret_scan, toxicity
from tidemark.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def features_by_hand(text: str, words: set[str], beginnings: set[str]) -> list[float]:
    """Every token in turn, with nothing remembered and nothing vectorised."""
    codes = []
    for token in text.split():
        core = re.sub(r"^[^\w@$]+|[^\w@$]+$", "", token)
        low = core.lower()
        plain = re.sub(r"[\W\d_]+", "", low)
        shown = "".join(toxicity.STANDS_FOR.get(c, c) for c in low)
        guesses = {re.sub(r"[\W\d_]+", "", shown), plain}
        guesses |= {re.sub(r"(.)\1{2,}", r"\1", g) for g in guesses}
        mixed = bool(plain) and plain != low
        squeezed = re.sub(r"(.)\1{2,}", r"\1", low)
        codes.append({
            "lexicon": low in words, "beginning": len(plain) > 5 and plain[:5] in beginnings, "second": low in toxicity.SECOND_PERSON, "caps": len(core) >= 3 and core.isupper(), "mixed": mixed,
            "hidden": bool(guesses & words) if mixed else low not in words and squeezed != low and squeezed in words,
        })
    n = max(1, len(codes))
    hits = {k: sum(c[k] for c in codes) for k in ("lexicon", "beginning", "hidden", "second", "caps", "mixed")}
    insults = [i for i, c in enumerate(codes) if c["lexicon"] or c["beginning"] or c["hidden"]]
    second = [i for i, c in enumerate(codes) if c["second"]]
    near = sum(any(abs(i - j) <= 5 for j in second) for i in insults)
    letters = max(1, sum(c.isalpha() for c in text))
    chars = max(1, len(text))
    punctuation = sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in text)
    return [hits["lexicon"] / n, hits["beginning"] / n, hits["hidden"] / n, *(min(hits[k], 5) for k in ("lexicon", "beginning", "hidden")), near / n, hits["second"] / n, sum(c.isupper() for c in text) / letters, hits["caps"] / n, punctuation / chars, sum(c in "!?" for c in text) / chars, sum(c in "#*$%&|<>@^~" for c in text) / chars, hits["mixed"] / n, math.log1p(n)]


def test_features_are_those_counted_by_hand(spark):
    rng = random.Random(3)
    words, beginnings = set(toxicity.INSULTS) | {"grumble"}, {"mumbl"}
    pool = ["you", "You,", "YOUR", "idiot", "IDIOT!", "1d10t", "id-iot", "idiooot", "grumble", "gr*mble", "mumbling", "mumbl", "word", "x_1", "(moron)", "m0r0n", "$tupid", "@#!", "tú", "ÉÀÜ", "ab", "loserrr", "123", "a1b2"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(300)] + ["", "\n\n", " you \t idiot\n"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    lexicon = toxicity.Lexicon(frozenset(words), frozenset(beginnings))
    got = lexicon.features(texts)
    for text, row in zip(texts, got, strict=True):
        assert row.tolist() == pytest.approx(features_by_hand(text, words, beginnings)), text[:200]


def test_lexicon_is_mined_as_by_counting(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(["common", rng.choice(["badword", "worseness", "fine"]) if k % 3 else rng.choice(["fine", "good"]), f"own{k}"] + ["filler"] * (k % 4)), int(k % 3 > 0)) for k in range(600)]
    rows += [(1000 + k, "copied text with copyword in it all", 1) for k in range(50)]  # one text, however often it is copied
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    once = {}
    for doc_id, text, label in rows:
        once.setdefault((text, label), doc_id)
    toxic, clean = Counter(), Counter()
    for text, label in once:
        own = {w for w in text.split() if 2 < len(w) <= 40} | {re.sub(r"[\W\d_]+", "", w)[:5] + "*" for w in text.split() if len(re.sub(r"[\W\d_]+", "", w)) > 5}
        (toxic if label else clean).update(own)
    t, c = sum(label for _, label in once), sum(1 - label for _, label in once)
    want = set()
    for term, n in toxic.items():
        m = clean[term]
        odds = math.log((n + 0.5) / (t - n + 0.5)) - math.log((m + 0.5) / (c - m + 0.5))
        if n >= 4 and n >= 4 * m and odds / math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5)) >= 3:
            want.add(term)
    lexicon = toxicity.mine_lexicon(sample)
    assert lexicon.words - set(toxicity.INSULTS) | {b + "*" for b in lexicon.beginnings} == want - set(toxicity.INSULTS)
    assert {"badword", "worseness"} <= lexicon.words and "copyword" not in lexicon.words and "common" not in lexicon.words


def pooled(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Adjacent violators pooled by hand: (raw, share) for each different raw."""
    blocks = []
    for x in sorted({p for p, _ in points}):
        ys = [y for p, y in points if p == x]
        blocks.append([[x], sum(ys), len(ys)])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            xs, s, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + xs, blocks[-1][1] + s, blocks[-1][2] + n]
    return [(x, s / n) for xs, s, n in blocks for x in xs]


def test_calibration_pools_adjacent_violators(spark):
    rng = random.Random(7)
    points = [(round(rng.random(), 2), 0.0) for _ in range(200)]
    points = [(x, float(rng.random() < x**2)) for x, _ in points]
    curve = toxicity.calibration(spark.createDataFrame(points, "raw double, label double"))
    got = {r.raw: r.score for r in curve.transform(spark.createDataFrame([(x,) for x, _ in points], "raw double")).collect()}
    assert all(got[x] == pytest.approx(y) for x, y in pooled(points))


def test_scores_rise_with_what_the_labels_call_toxic(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), Scratch(spark, "t")).join(labels, "doc_id")
    r = scored.agg(F.avg(F.when(F.col("toxic") == 1, F.col("score"))).alias("a"), F.avg(F.when(F.col("toxic") == 0, F.col("score"))).alias("b"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a > r.b + 0.5 and 0 <= r.lo and r.hi <= 1


ENCODINGS = {"HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "lower36": "0123456789abcdefghijklmnopqrstuvwxyz", "base62": None, "base64": None, "base64url": None}
LENGTHS = (24, 32, 40, 64)


def planted(rng) -> tuple[list[tuple[int, str]], dict[int, tuple[str, int]], int]:
    """Random keys of every encoding and length between ordinary long runs, and which row holds which."""
    pools = {n: list(a or secret_scan._ALPHABETS[n]) for n, a in ENCODINGS.items()}
    kinds, rows = {}, []
    for name, pool in pools.items():
        for n in LENGTHS:
            for _ in range(25):
                kinds[len(rows)] = (name, n)
                rows.append((len(rows), f"value <{''.join(rng.choice(pool, n))}> follows"))
    words = "the quick brown fox jumps over lazy dog while account settings remain visible under profile manager session handler".split()
    for k in range(1500):
        some = [words[i] for i in rng.integers(0, len(words), 6)]
        run = ("_".join(some), "-".join(some), "/".join(some), "".join(w.title() for w in some), f"2024-0{k % 9 + 1}-1{k % 9}-{k:05d}-{k * 7:06d}", f"{'-'.join(some[:3])}-{k}", "=" * 30, "ab" * 15, "X" * 40)[k % 9]
        rows.append((len(rows), f"see {run} there"))
    return rows, kinds, len(kinds)


def test_recall_and_false_discoveries_over_encodings_and_lengths(spark):
    rows, kinds, keys = planted(np.random.default_rng(4))
    found = {r.doc_id: [s for s in r.secret_spans if secret_scan.KINDS[s.kind] == "random"] for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), Scratch(spark, "t")).collect()}
    false = sum(bool(found[k]) for k in range(keys, len(rows)))
    hit = Counter(kinds[k] for k in kinds if any(s.start == 7 and s.end == 7 + kinds[k][1] for s in found[k]))
    report = {name: [hit[name, n] / 25 for n in LENGTHS] for name in ENCODINGS}
    print("recall by length", LENGTHS, report, "false", false, "of", len(rows) - keys)
    assert false <= 0.02 * (false + sum(hit.values()))
    assert all(min(report[name][2:]) >= 0.8 for name in ("base62", "base64", "base64url", "lower36", "base32", "HEX"))
    assert sum(hit.values()) / keys >= 0.8
