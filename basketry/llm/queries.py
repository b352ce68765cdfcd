"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from basketry.llm import (exact_dedup, fingerprint, hard_negatives, lm_scoring, mixing, packing, prefix_trie, quality,
                          sentence_pieces, sharding, simhash, suffix_dedup, url_filter)

QUERIES = {
    "op1_url_filters": url_filter.query,
    "op2_simhash": simhash.query,
    "op3_fingerprints": fingerprint.query,
    "op4_quality": quality.query,
    "op5_suffix_dedup": suffix_dedup.query,
    "op6_exact_dedup": exact_dedup.query,
    "op7_packing": packing.query,
    "op8_sharding": sharding.query,
    "op9_lm_scoring": lm_scoring.query,
    "op10_mixing": mixing.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_sentence_pieces": sentence_pieces.query,
    "op13_prefix_trie": prefix_trie.query,
}

ORACLE = {
    "op1_url_filters": url_filter.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
