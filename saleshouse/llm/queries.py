"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import (
    conversation_trie, language_id, license_scan, line_dedup, ngram_join, parse_dedup, quality_model, quality_rules, sentencepiece_sa, source_mix, url_filter, vector_search, whitening,
)

QUERIES = {
    "op1_url_aliases": url_filter.op1_url_aliases,
    "op2_multi_index": vector_search.op2_multi_index,
    "op3_quality_ftrl": quality_model.op3_quality_ftrl,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_source_mix": source_mix.op5_source_mix,
    "op6_quality_cascade": quality_rules.op6_quality_cascade,
    "op7_language_zstd": language_id.op7_language_zstd,
    "op8_license_rules": license_scan.op8_license_rules,
    "op9_fuzzy_lines": line_dedup.op9_fuzzy_lines,
    "op10_sentencepiece": sentencepiece_sa.op10_sentencepiece,
    "op11_prefix_trie": conversation_trie.op11_prefix_trie,
    "op12_prefix_free": parse_dedup.op12_prefix_free,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op1_url_aliases": url_filter.SQL,
    "op6_quality_cascade": quality_rules.SQL,
    "op11_prefix_trie": conversation_trie.SQL,
    "op12_prefix_free": parse_dedup.SQL,
}
