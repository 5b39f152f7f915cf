"""Mixing rows that share an id, reading damaged stores, and outliers' steps without a cap."""

import math
from collections import Counter

import numpy as np
import pytest
from compare import duck
from pyspark.sql import functions as F
from test_corpus_operators import ids_of

from tidemark.llm import content_store, mixing
from tidemark.llm.common import Scratch

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"


@pytest.fixture(scope="module")
def shared_ids():
    rows = [(None, f"word {k}" + " more" * (k % 5), f"null{k % 3}", "en", 1) for k in range(3000)]
    rows += [(7, "the same four words", "same", "en", 1)] * 1000
    rows += [(9, f"{k} texts of one id", "one id", "en", 1) for k in range(500)]
    return rows


def test_mix_meets_its_targets_where_ids_are_null_or_repeated(spark, shared_ids):
    df = spark.createDataFrame(shared_ids, SCHEMA).repartition(5)
    got = mixing.mix(df, Scratch(spark, "t")).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"), F.max("source_size").alias("of")).collect()
    assert len(got) == 5
    for r in got:
        assert abs(r.taken - r.target) <= r.most and r.target <= 3 * r.of
    again = [mixing.mixed_documents(df, Scratch(spark, "t")).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect() for _ in range(2)]
    assert {r.source: r.n for r in again[0]} == {r.source: r.n for r in again[1]} == {r.source: r.taken for r in got}


def test_mix_of_shared_ids_equals_its_sql(spark, shared_ids, tmp_path):
    spark.createDataFrame(shared_ids, SCHEMA).write.parquet(f"file://{tmp_path}/documents.parquet")
    con = duck("/root/testdata/sf0.001")
    con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = Counter(con.sql(mixing.SQL).fetchall())
    got = mixing.op6(spark, f"file://{tmp_path}").select("doc_id", "size", "source_size", "target", "taken").collect()
    rounded = lambda rows: Counter((*r[:3], round(r[3], 5), r[4]) for r in rows)
    assert rounded(got) == rounded(want.elements())


def test_cut_takes_the_nearest_number_of_equal_rows():
    for budget, rows, size in ((0.4, 10, 7), (3.5, 10, 7), (3.6, 10, 7), (35, 10, 7), (69.9, 10, 7), (5, 1, 11), (6, 1, 11)):
        n = mixing._Cut(budget, 0, 0, rows * size, rows).taken()
        assert 0 <= n <= rows and abs(n * size - budget) == min(abs(k * size - budget) for k in range(rows + 1))
        assert n == math.ceil(budget / size - 0.5)


@pytest.mark.parametrize("harm", ["a chunk lost", "a chunk changed", "a recipe lost", "a manifest row lost"])
def test_damaged_stores_give_no_short_documents(spark, harm):
    texts = ["unlike all others " * 300, "short", None, " ".join(str(k) for k in range(3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path, bent = Scratch(spark, "t").root, Scratch(spark, "t").root
    content_store.write_store(docs, path, "word_bpe_49k.json", 1)
    want = dict(enumerate(ids_of("word_bpe_49k.json", texts, 1)))
    first = spark.read.parquet(f"{path}/recipes").where("doc_id = 3").select("digests", "shard").first()
    key, shard = bytes(first.digests[:16]), first.shard
    for part in ("entries", "recipes", "manifest"):
        rows = spark.read.parquet(f"{path}/{part}")
        if part == "entries" and harm == "a chunk lost":
            rows = rows.where((F.col("kind") != "chunk") | (F.col("digest") != F.lit(key)))
        if part == "entries" and harm == "a chunk changed":
            rows = rows.withColumn("payload", F.when(F.col("digest") == F.lit(key), F.concat(F.lit(b"\x01\x00"), F.expr("substring(payload, 3)"))).otherwise(F.col("payload")))
        if part == "recipes" and harm == "a recipe lost":
            rows = rows.where("doc_id <> 3")
        if part == "manifest" and harm == "a manifest row lost":
            rows = rows.where(F.col("shard") != shard)
        (rows.write.partitionBy("kind") if part == "entries" else rows.write).parquet(f"{bent}/{part}")
    got = {r.doc_id: r.ids for r in content_store.read_documents(spark, bent).collect()}
    for doc_id, ids in got.items():
        assert ids is None or np.frombuffer(ids, "<u2").tolist() == list(want[doc_id])
    assert got.get(3) is None and (harm == "a recipe lost") == (3 not in got)
    if harm.startswith("a chunk"):
        assert got[1] is not None and got[2] is not None
