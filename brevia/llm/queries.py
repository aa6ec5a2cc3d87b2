"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brevia.llm import (
    bpe_codec,
    decontaminate,
    filter_audit,
    importance_resampling,
    jaccard_join,
    kn_quality,
    line_dedup,
    lz_fingerprint,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        url_filters.op1_url_filters,
        token_files.op2_token_files,
        bpe_codec.op3_bpe_codec,
        lz_fingerprint.op4_lz_fingerprints,
        jaccard_join.op5_jaccard_join,
        token_counts.op6_token_counts,
        decontaminate.op7_decontaminate,
        line_dedup.op8_line_dedup,
        substring_dedup.op9_substring_dedup,
        kn_quality.op10_kn_quality,
        filter_audit.op11_filter_audit,
        suffix_dedup.op12_suffix_dedup,
        importance_resampling.op13_importance_resampling,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": url_filters.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op11_filter_audit": filter_audit.SQL,
}
