"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import (
    clustering,
    decontaminate,
    language,
    licenses,
    merkle,
    packing,
    quality,
    simhash,
    sitetree,
    suffix,
    token_counts,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES = [
    packing.op1_best_fit_packing,
    quality.op2_quality_rules,
    sitetree.op3_html_extraction,
    token_counts.op4_token_counts,
    simhash.op5_simhash_near_dedup,
    suffix.op6_suffix_array_dedup,
    language.op7_language_id,
    decontaminate.op8_benchmark_decontamination,
    licenses.op9_license_scan,
    toxicity.op10_toxicity,
    clustering.op11_centroid_clustering,
    merkle.op12_merkle_manifest,
    warc.op13_warc,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": quality.ORACLE_SQL,
        "op8_benchmark_decontamination": decontaminate.ORACLE_SQL,
        "op11_centroid_clustering": clustering.ORACLE_SQL,
        "op12_merkle_manifest": merkle.ORACLE_SQL,
        "op13_warc": warc.ORACLE_SQL,
    }
