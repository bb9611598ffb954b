"""Registry of the operators' contract queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, decontaminate, hard_negatives, html_text, jaccard_join, language_id, merkle, quality_model, secret_scan, token_files, toxicity, vector_search, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan.query,
    "op2_token_files": token_files.query,
    "op3_jaccard_join": jaccard_join.query,
    "op4_html_text": html_text.query,
    "op5_decontaminate": decontaminate.query,
    "op6_quality_model": quality_model.query,
    "op7_toxicity": toxicity.query,
    "op8_vector_search": vector_search.query,
    "op9_byte_bpe": byte_bpe.query,
    "op10_language_id": language_id.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_merkle": merkle.query,
    "op13_whitening": whitening.query,
}

ORACLE_SQL: dict[str, str] = {"op11_hard_negatives": hard_negatives.SQL}
