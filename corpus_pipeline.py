"""The training-data pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns documents with the columns of ``documents``; the last one returns
packed pieces.  Between stages documents are written and read again.

Null, empty and very long texts, repeated rows and further columns pass through
as each operator defines; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, packing, quality, simhash, suffix
from gridloom.llm.common import Scratch, prepare, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule or their host's verdict rejects go."""
    prepare(spark)
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    prepare(spark)
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that start anywhere else go; every document stays."""
    prepare(spark)
    return suffix.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    prepare(spark)
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, removed bytes and token ids have no SQL; the tests hold every
#: stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, scratch.settle(stage(spark, docs, sf_dir))
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
