"""Corpus pipeline: documents in, a weighted, clean training mix out.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it
keeps, with the columns of ``documents``. Between stages the documents are
written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parlance.llm import decontaminate, jaccard, mixing, quality, secrets
from parlance.llm.queries import QUALITY_THRESHOLD, table
from parlance.llm.storage import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold go. The model learns from the documents of this stage."""
    weights = quality.train(spark, docs, table(spark, sf_dir, "labels"))
    return quality.good_documents(spark, docs, weights, QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the one with the smallest id."""
    return jaccard.one_per_group(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.without_contamination(spark, docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; a mark replaces every secret in their texts."""
    return secrets.redacted(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the weights of the sources ask for."""
    return mixing.mix_documents(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_sources),
]

# The classifier is a trained model, which SQL cannot express; the pipeline is
# tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` to the mix."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(spark, docs, f"pipeline-{number}")
    return docs
