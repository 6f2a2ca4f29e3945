"""Queries of the operators and the SQL that gives the same rows.

Every query reads its whole table. SQL is given where DuckDB can express the
result over whole texts; the others are tested against brute force in
``tests/llm``.
"""

from __future__ import annotations

from quarry.llm import (decontamination, packing, paragraph_sketch, quality_model, resampling, rule_cascade,
                        sharding, simhash_dedup, source_mix, suffix_dedup, token_counts, url_rules, whitening)

QUERIES = {
    "op1_url_filters": url_rules.query,
    "op2_quality_classifier": quality_model.query,
    "op3_document_fingerprints": paragraph_sketch.query,
    "op4_quality_rules": rule_cascade.query,
    "op5_suffix_array_dedup": suffix_dedup.query,
    "op6_sharding": sharding.query,
    "op7_simhash_near_dedup": simhash_dedup.query,
    "op8_mixing_sources": source_mix.query,
    "op9_token_counts": token_counts.query,
    "op10_best_fit_packing": packing.query,
    "op11_benchmark_decontamination": decontamination.query,
    "op12_importance_resampling": resampling.query,
    "op13_embedding_whitening": whitening.query,
}

ORACLES: dict[str, str] = {
    "op4_quality_rules": rule_cascade.ORACLE,
    "op5_suffix_array_dedup": suffix_dedup.ORACLE,
    "op8_mixing_sources": source_mix.ORACLE,
    "op11_benchmark_decontamination": decontamination.ORACLE,
    "op12_importance_resampling": resampling.ORACLE,
}
