"""The divergence audit against its SQL and against plain counting."""

import re
from collections import Counter, defaultdict

from compare import differences, duck
from pyspark.sql import functions as F

from tidemark.llm import divergence
from tidemark.llm.common import Scratch

SF = "/root/testdata/sf0.01"
SCHEMA = "text string, lang string, source string"


def by_hand(rows, least: int, top: int) -> list[tuple]:
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        total = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        share = lambda own, t: 1 + 10**9 * (own[t] + 5) // (sum(own[x] for x in kept) + 5 * len(kept))
        p = {s: {t: share(counts[lang, s], t) for t in kept} for s in sources}
        q = {t: share(total, t) for t in kept}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(ranked[: None if part == "pair" else top])]
    return sorted(out)


def got(df, spark, **given) -> list[tuple]:
    return sorted(tuple(r) for r in divergence.audit(df, Scratch(spark, "t"), **given).collect())


def test_query_equals_its_sql(spark):
    assert not differences(divergence.op13(spark, SF), duck(SF), divergence.SQL)


def test_ties_and_odd_rows(spark):
    rows = [(f"tie{k % 5} Word{'abcdefgh'[k % 8]} ÉÀ é\U0001f600x a1b_c", ("en", None, "")[k % 3], f"s{k % 7}" if k % 7 else None) for k in range(200)]
    rows += [(None, "en", "only"), (None, None, None), ("", "xx", "alone"), ("zz yy", "xx", "other"), ("long " * 300_000 + "tail", "en", "s1")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("term", "n", "total", "value", "rank", "by")})
    for given in ({"least": 1, "top": 3}, {"least": 2, "top": 1}, {"least": 5, "top": 50}):
        assert got(df, spark, **given) == by_hand(rows, **given)


def test_classes_of_equal_value_are_cut_in_byte_order(spark):
    """More terms than ranks share each value, in cells of their own."""
    rows = [(" ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)) + " é z", "en", "a")] * 3 + [("z other", "en", "b")] * 3
    assert got(spark.createDataFrame(rows, SCHEMA), spark, least=1, top=50) == by_hand(rows, 1, 50)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA), spark) == []


def test_shares_past_what_one_product_holds(spark):
    import numpy as np

    counts = [0, 1, 10**12, 123_456_789_012, 10**13 - 7]
    want = [1 + 10**9 * (c + 5) // (10**13 + 5 * 1_000_003) for c in counts]
    df = spark.createDataFrame([(c,) for c in counts], "c long").select(divergence.share(F.col("c"), F.lit(10**13), F.lit(1_000_003)).alias("p"))
    assert [r.p for r in df.collect()] == want
    assert divergence.shares(np.array(counts), np.array(10**13 + 5 * 1_000_003)).tolist() == want


def test_texts_are_split_alike_in_pieces(monkeypatch):
    text = "Aé b,c " * 500
    whole = divergence.text_terms(text.encode())
    monkeypatch.setattr(divergence, "_PIECE", 7)
    assert divergence.text_terms(text.encode()) == whole == Counter({"aé".encode(): 500, b"b": 500, b"c": 500})


def test_entries_told_early(spark, monkeypatch):
    import pyarrow as pa

    rows = [(f"w{chr(97 + k % 26)} common", "en", f"s{k % 3}") for k in range(100)]
    monkeypatch.setattr(divergence, "_ENTRIES", 5)
    batches = [pa.RecordBatch.from_pydict({"lang": [r[1]], "source": [r[2]], "text": [r[0].encode()]}) for r in rows]
    told = [x for b in divergence._counted(iter(batches)) for x in b.to_pylist()]
    assert sum(x["docs"] for x in told if x["term"] is None) == 100 and sum(x["n"] for x in told if x["term"] == "common") == 100
