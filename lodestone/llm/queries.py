"""The corpus operators as named queries, with production parameters over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import conversations, decontaminate, dual_tree, language, mixing, near_dedup, quality_model, quality_rules, secret_scan, sharding, substring_dedup, token_count, token_output
from lodestone.llm.common import scratch_root, table

SHARD_LIMIT = 1 << 20  # bytes of text in a shard
CENTROIDS, ROUNDS, WIDTH = 40, 5, 64  # of the clustering


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/token-shards-{uuid.uuid4().hex}"
    token_output.write_token_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_output.token_digest(spark, path)


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.quality_scores(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), max_repeats=4.0)
    return out.select("doc_id", "source", "__mix.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_LIMIT)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repairs(table(spark, sf_dir, "conversations"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.clusters(table(spark, sf_dir, "embeddings"), CENTROIDS, ROUNDS, WIDTH)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.languages(docs, language.train(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_output, op2_quality_model, op3_mixing, op4_quality_rules, op5_near_dedup, op6_secret_scan, op7_substring_dedup, op8_sharding, op9_decontamination, op10_token_count, op11_conversation_repair, op12_centroid_clustering, op13_language_id)}
