"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from pitwall.llm import (
    alignment,
    bpe,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    license_scan,
    packing,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    url_filter,
    warc,
)

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_url_filter": url_filter.query,
    "op4_mcd_quality": quality.query,
    "op5_exact_dedup": exact_dedup.query,
    "op6_byte_bpe": bpe.query,
    "op7_nnls_packing": packing.query,
    "op8_jaccard_join": jaccard_join.query,
    "op9_secret_scan": secret_scan.query,
    "op10_warc_fixity": warc.query,
    "op11_simhash_anchors": simhash.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_token_alignment": alignment.query,
}

#: The others cannot be put in SQL; tests/llm holds them to brute force.
ORACLE = {
    "op3_url_filter": url_filter.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op10_warc_fixity": warc.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
