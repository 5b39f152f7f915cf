"""Corpus preparation as stages over `documents`; each stage's result is written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, closing, numbered
from tidemark.llm.linear_grouping import pack
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.secret_scan import redact
from tidemark.llm.simhash import without_near_duplicates
from tidemark.llm.toxicity import THRESHOLD, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score is below the threshold, with all their columns."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    own, names, back = numbered(docs)
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    scored = score_toxicity(own, labels, Scratch(spark, "pipeline-toxicity"), id_col=doc_id, text_col=text)
    return scored.where(F.col("score") < THRESHOLD).select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest doc_id."""
    return without_near_duplicates(docs, Scratch(spark, "pipeline-simhash"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind."""
    return redact(docs, Scratch(spark, "pipeline-secrets"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights has them: none, or up to three times."""
    return mixed_documents(docs, Scratch(spark, "pipeline-mixing"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that was kept, with the pieces' token ids; see linear_grouping.pack for the columns."""
    return pack(docs, Scratch(spark, "pipeline-packing"))


STAGES = [
    ("toxicity", toxicity),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]
#: Learnt scores, fingerprints and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage but the last has written for itself goes once its result stands."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with closing():
            docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
