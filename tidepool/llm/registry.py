"""Queries of this subpackage and their SQL twins (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import (best_fit, html_text, importance_sample, language_id, line_dedup, lz_fingerprint,
                          minhash_dedup, ngram_join, pivot_codes, quality_rules, token_counts, toxicity, viterbi_pieces)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": html_text.op1_html_text,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_best_fit": best_fit.op5_best_fit,
    "op6_viterbi_pieces": viterbi_pieces.op6_viterbi_pieces,
    "op7_language_id": language_id.op7_language_id,
    "op8_lz_fingerprint": lz_fingerprint.op8_lz_fingerprint,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_minhash_dedup": minhash_dedup.op11_minhash_dedup,
    "op12_pivot_codes": pivot_codes.op12_pivot_codes,
    "op13_importance_sample": importance_sample.op13_importance_sample,
}

ORACLE: dict[str, str] = {
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
    "op12_pivot_codes": pivot_codes.OP12_SQL,
    "op13_importance_sample": importance_sample.OP13_SQL,
}
