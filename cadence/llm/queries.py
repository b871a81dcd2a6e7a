"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadence.llm import divergence, idfiles, leakage, lines, minhash, outliers, packing, passages, quality, tokens, toxicity, trie, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(_table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return urls.filter_urls(urls.captures_of(pages), urls.list_from(pages))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicate_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.over_limit(counts, 512)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), remembered=1_500_000)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash_near_dedup, op2_substring_dedup, op3_quality_classifier, op4_quality_rules, op5_url_filters, op6_benchmark_decontamination, op7_line_dedup, op8_token_counts, op9_toxicity, op10_best_fit_packing, op11_conversation_trie, op12_token_id_output, op13_source_divergence)}


def oracles() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""
    return {"op5_url_filters": urls.ORACLE_SQL, "op7_line_dedup": lines.ORACLE_SQL, "op11_conversation_trie": trie.ORACLE_SQL, "op13_source_divergence": divergence.ORACLE_SQL}
