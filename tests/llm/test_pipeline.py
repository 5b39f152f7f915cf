"""Each stage of the pipeline against what its operator or brute force says about the stage's own input."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_corpus_operators import SF, ids_of, packed, print_by_hand

from tidemark.llm import mixing, toxicity
from tidemark.llm.common import Scratch


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, scratch = docs.columns, Scratch(spark, "t")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = scratch.save(stage(spark, before, SF), name.replace(" ", "-"))
        out[name] = (before, docs)
        assert name == names[-1] or docs.columns == columns

    before, after = out["toxicity"]
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(before.select("doc_id", "text"), labels, Scratch(spark, "t")).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}

    before, after = out["SimHash near-dedup"]
    texts = {r.doc_id: r.text for r in before.collect()}
    prints = {i: print_by_hand(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    for a in sorted(texts):  # the smallest doc_id of each component, by repeated passes
        for b in texts:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    kept = [r.doc_id for r in after.collect()]
    assert sorted(kept) == sorted(set(group.values()))

    before, after = out["secret scans"]
    clean = {r.doc_id: r for r in after.collect()}
    from test_corpus_operators import base_spans

    for r in before.collect():
        got = clean[r.doc_id]
        assert (got.text == r.text) == (not base_spans(r.text)) or "[random]" in got.text
        assert got.n_chars == len(got.text) and not [s for s in base_spans(got.text) if not s.startswith("assign")]

    before, after = out["mixing sources to target weights"]
    times = {r.doc_id: r.times for r in mixing.mix(before, Scratch(spark, "t")).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({i: n for i, n in times.items() if n})

    before, after = out["best-fit packing"]
    rows = before.collect()
    packed(after.collect(), list(zip([r.doc_id for r in rows], ids_of("byte_bpe_50k.json", [r.text for r in rows], 0), strict=True)))


def test_run_gives_the_stages_rows(spark):
    a = corpus_pipeline.run(spark, SF)
    assert a.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    rows = a.collect()
    assert len(rows) > 100 and all(len(r.ids) == 2 * r.length for r in rows)


NAMES = "score features raw prediction probability rawPrediction secret_base secret_runs secret_spans _source _times _copy _cut _passes _features fp uid component _0 _1 n_chars source lang start Score2".split()


def test_stages_leave_columns_of_any_name_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.select("doc_id", *(F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in NAMES if n != "n_chars"), F.length("text").alias("n_chars"), "text")
    scratch = Scratch(spark, "t")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, SF), f"named-{name}".replace(" ", "-"))
    assert docs.columns == ["doc_id", *(n for n in NAMES if n != "n_chars"), "n_chars", "text"]
    rows = docs.collect()
    assert len(rows) > 100
    for r in rows:
        assert all(r[n] == f"{n}-{r.doc_id}" for n in NAMES if n != "n_chars") and r.n_chars == len(r.text or "")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= len(rows)


def test_stages_leave_no_scratch_behind(spark):
    import os

    root = f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file://')}"
    before = set(os.listdir(root))
    corpus_pipeline.run(spark, SF)
    left = {x.split("-")[1] for x in set(os.listdir(root)) - before if os.listdir(f"{root}/{x}")}
    assert not left & {"toxicity", "simhash", "secrets", "mixing"}


def test_near_dedup_broadcasts_no_keys(spark, monkeypatch):
    plans, save = {}, Scratch.save

    def noted(self, df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name, *more)

    monkeypatch.setattr(Scratch, "save", noted)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < corpus_pipeline.near_dedup(spark, docs, SF).count() < docs.count()
    assert "SortMergeJoin" in plans["links"] and "Broadcast" not in plans["links"]
