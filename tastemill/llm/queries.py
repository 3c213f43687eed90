"""The registered queries of this folder and the SQL that DuckDB can run for them."""

from __future__ import annotations

from . import (
    best_fit_packing,
    byte_bpe,
    embedding_dedup,
    filter_audit,
    html_text,
    mixing,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    token_files,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_html_text": html_text.query,
    "op3_token_files": token_files.query,
    "op4_source_mix": mixing.query,
    "op5_url_filter": url_filter.query,
    "op6_byte_bpe": byte_bpe.query,
    "op7_embedding_dedup": embedding_dedup.query,
    "op8_best_fit_shards": sharding.query,
    "op9_simhash_golay": simhash.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_embedding_whitening": whitening.query,
    "op12_best_fit_packing": best_fit_packing.query,
    "op13_filter_audit": filter_audit.query,
}

ORACLE_SQL = {
    "op4_source_mix": mixing.ORACLE,
    "op5_url_filter": url_filter.ORACLE,
    "op7_embedding_dedup": embedding_dedup.ORACLE,
    "op10_suffix_dedup": suffix_dedup.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
