"""Registered queries of the corpus operators: name -> callable(spark, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardlens.llm import (cotraining, decontaminate, html_text, itq_join, jaccard_join, language, lexical, licenses,
                          linkgraph, mixing, token_files, toxicity, whitening)
from wardlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def token_options() -> token_files.TokenOptions:
    import public_tokenizers

    return token_files.TokenOptions(public_tokenizers.path("word_bpe_49k.json"))


def op1_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenize_to_files(table(spark, sf_dir, "documents"), token_options())


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge_urls(table(spark, sf_dir, "pages"))


def op7_itq_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.classify_languages(table(spark, sf_dir, "documents"))


def op13_vector_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {name: q for name, q in globals().items() if name.startswith("op") and callable(q)}


def oracle_sql() -> dict[str, str]:
    return {"op11_ranked_search": lexical.SQL}
