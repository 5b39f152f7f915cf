"""The corpus operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import content_store, divergence, exact_topk, line_crf, linear_grouping, merkle_log, mixing, robust_outliers, secret_scan, simhash, text_tree, toxicity, url_rules
from tidemark.llm.common import release  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mcd_outliers": robust_outliers.op1,
    "op2_gbt_toxicity": toxicity.op2,
    "op3_content_store": content_store.op3,
    "op4_linear_grouping": linear_grouping.op4,
    "op5_url_rules": url_rules.op5,
    "op6_mixing": mixing.op6,
    "op7_golay_simhash": simhash.op7,
    "op8_nra_topk": exact_topk.op8,
    "op9_line_crf": line_crf.op9,
    "op10_secret_battery": secret_scan.op10,
    "op11_merkle_log": merkle_log.op11,
    "op12_text_tree": text_tree.op12,
    "op13_source_divergence": divergence.op13,
}
ORACLE_SQL: dict[str, str] = {
    "op5_url_rules": url_rules.SQL,
    "op6_mixing": mixing.SQL,
    "op8_nra_topk": exact_topk.SQL,
    "op11_merkle_log": merkle_log.SQL,
    "op12_text_tree": text_tree.SQL,
    "op13_source_divergence": divergence.SQL,
}
