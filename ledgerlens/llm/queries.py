"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import (
    ann, ball_codes, decontaminate, mixing, prefix_bpe, prefix_trie, secret_scan, sharding, simhash, token_counts, token_store, toxicity,
    url_filter,
)
from ledgerlens.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("score")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_codes.code_digest(table(spark, sf_dir, "embeddings"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return prefix_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_sharding, op3_simhash, op4_decontamination, op5_toxicity, op6_mixing, op7_token_store,
        op8_cross_polytope, op9_url_filter, op10_secret_scan, op11_prefix_trie, op12_ball_codes, op13_prefix_bpe,
    )
}
SQL_TEXTS: dict[str, str] = {
    "op2_sharding": sharding.sql(), "op6_mixing": mixing.sql(), "op9_url_filter": url_filter.sql(), "op10_secret_scan": secret_scan.sql(),
    "op11_prefix_trie": prefix_trie.sql(), "op12_ball_codes": ball_codes.sql(),
}
