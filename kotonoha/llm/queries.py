"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embedding_graph, importance, jaccard, lexical_search, license_scan, mixing, packing, pii, quality_model, quality_rules, sharding, toxicity, url_filter
from .common import table


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_graph.embedding_groups(table(spark, sf_dir, "embeddings"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filtered_urls(table(spark, sf_dir, "pages"))


def op8_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.packed_documents(table(spark, sf_dir, "documents"), *tokenizer_files())
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.license_scan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_quality_rules, op3_source_mixing, op4_personal_data, op5_quality_classifier,
        op6_embedding_graph, op7_url_rules, op8_balanced_shards, op9_best_fit_packing, op10_ngram_jaccard,
        op11_license_scan, op12_lexical_search, op13_importance_resampling,
    )
}
#: The others train models, iterate, tokenize or hash in ways that SQL cannot express; tests hold them to brute force.
ORACLE_SQL: dict[str, str] = {"op7_url_rules": url_filter.ORACLE_SQL, "op11_license_scan": license_scan.ORACLE_SQL, "op12_lexical_search": lexical_search.ORACLE_SQL}
