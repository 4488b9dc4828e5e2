"""Registered queries of the training-data operators. Each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from parlance.llm import (
    alignment, decontaminate, jaccard, language, lexical, mixing, quality, rules, secrets, suffixes, templates, toxicity,
    urls,
)

QUALITY_THRESHOLD = 0.3
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 5, 0
TOXICITY_FOLDS, TOXICITY_HELD_OUT = 3, 1
TOXICITY_THRESHOLD = 0.7
URL_RULES = (
    urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"),
    urls.Rule("allow", "org/fr/"),
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    return rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = quality.id_fold(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    model = language.train(spark, documents, ~held_out)
    return language.languages(spark, documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op3_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_groups(spark, table(spark, sf_dir, "documents"))


@query
def op4_mix_sources(spark, sf_dir):
    return mixing.mixed(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op5_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = quality.id_fold(F.col("doc_id"), TOXICITY_FOLDS) == TOXICITY_HELD_OUT
    model = toxicity.train(spark, documents, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.toxicity_scores(spark, documents, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= TOXICITY_THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op6_repeated_passages(spark, sf_dir):
    """One row per repeated passage; documents that repeat nothing have none."""
    found = suffixes.repeated_passages(spark, table(spark, sf_dir, "documents"))
    passages = found.select("doc_id", "n_words", F.explode("passages").alias("p"))
    return passages.select(
        "doc_id", F.col("p.start").cast("bigint").alias("start_word"), F.col("p.end").cast("bigint").alias("end_word"),
        F.col("n_words").alias("doc_words"),
    )


@query
def op7_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op8_html_text(spark, sf_dir):
    return templates.main_texts(spark, table(spark, sf_dir, "pages"))


@query
def op9_secrets(spark, sf_dir):
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    weights = quality.train(spark, documents, table(spark, sf_dir, "labels"))
    scores = quality.quality_scores(spark, documents, weights)
    return scores.select(
        "doc_id", (quality.id_fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op11_align_tokens(spark, sf_dir):
    return alignment.cross_alignment(spark, table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark, sf_dir):
    return lexical.ranked_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = urls.judged(spark, pages, urls.train(spark, pages), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "score")
