"""The registered query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationqc.llm import (
    cross_tokens,
    fingerprints,
    html_templates,
    jaccard_join,
    licenses,
    mixing,
    packing,
    quality_rules,
    secrets,
    source_audit,
    token_files,
    toxicity,
    url_lists,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extract_html": html_templates.op1_extract_html,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_token_files": token_files.op5_token_files,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_pack_sequences": packing.op9_pack_sequences,
    "op10_ngram_jaccard": jaccard_join.op10_ngram_jaccard,
    "op11_url_filter": url_lists.op11_url_filter,
    "op12_source_audit": source_audit.op12_source_audit,
    "op13_cross_tokens": cross_tokens.op13_cross_tokens,
}

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": licenses.ORACLE_SQL,
    "op4_quality_rules": quality_rules.ORACLE_SQL,
    "op8_mix_sources": mixing.ORACLE_SQL,
    "op11_url_filter": url_lists.ORACLE_SQL,
    "op12_source_audit": source_audit.ORACLE_SQL,
}
