"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from tastemine.llm import (
    conversation_repair,
    exact_dedup,
    license_scan,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    substring_dedup,
    token_counts,
    whitening,
)

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_quality_classifier": quality_model.query,
    "op4_license_scan": license_scan.query,
    "op5_mixing": mixing.query,
    "op6_simhash_dedup": simhash.query,
    "op7_pii": pii.query,
    "op8_quality_rules": quality_rules.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_best_fit_packing": packing.query,
    "op11_embedding_whitening": whitening.query,
    "op12_conversation_repair": conversation_repair.query,
    "op13_token_counts": token_counts.query,
}
ORACLE = {
    "op2_substring_dedup": substring_dedup.SQL,
    "op4_license_scan": license_scan.SQL,
    "op5_mixing": mixing.SQL,
    "op8_quality_rules": quality_rules.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op12_conversation_repair": conversation_repair.SQL,
}
