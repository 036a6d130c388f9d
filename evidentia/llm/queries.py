"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from evidentia.llm import fingerprints, html_text, mixing, near_dedup, packing, quality_classifier, quality_rules, suffix_dedup, token_counts, url_filter

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_packing": packing.op6_packing,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_quality_classifier": quality_classifier.op8_quality_classifier,
    "op9_html_text": html_text.op9_html_text,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
}
ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op7_near_dedup": near_dedup.OP7_SQL,
    "op10_suffix_dedup": suffix_dedup.OP10_SQL,
}
