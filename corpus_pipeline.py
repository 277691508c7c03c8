"""From raw documents to token shards: five stages, each over all that the one before has kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, mixing, simhash, token_store, toxicity
from ledgerlens.llm.common import table
from ledgerlens.operators.stability import checkpoint_folder

# The stages fit no SQL: a fitted model, a 64-bit hash that SQL engines lack, alignments and a tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those of severity grade 1 or more."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id; rows that repeat id and text are one document.

    Only rows that are copies go: an id that stands on several texts keeps those that are none.
    Documents without an id count after all others of their group.
    """
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item was found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all documents; per document what reading them back gives."""
    return token_store.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
    ("token_store", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = f"{checkpoint_folder(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
