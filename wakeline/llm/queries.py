"""The opN queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe, hmm_lm, line_dedup, media_columns, near_dedup, packing, quality_classifier, quality_rules, secret_scan, url_filter

QUERIES = {
    "op1_fuzzy_lines": line_dedup.query,
    "op2_quality_rules": quality_rules.query,
    "op3_nb_svm_quality": quality_classifier.query,
    "op4_webp_columns": media_columns.query,
    "op5_bloom_cascade": url_filter.query,
    "op6_hmm_lm": hmm_lm.query,
    "op7_fast_sketch_dedup": near_dedup.query,
    "op8_secret_ledger": secret_scan.query,
    "op9_bpe_transducer": bpe.query,
    "op10_best_fit_packing": packing.query,
}

#: The others can't be stated in SQL; tests/llm holds their brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality_rules.SQL,
    "op5_bloom_cascade": url_filter.SQL,
    "op7_fast_sketch_dedup": near_dedup.SQL,
}
