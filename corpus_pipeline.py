"""A training corpus from raw documents: clean, distinct, uncontaminated, mixed and sharded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.  A
stage's result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.llm import decontamination, mixing, near_dedup, sharding, toxicity
from loamline.llm.common import materialize, quoted, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


def drop_benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that they share with the benchmark."""
    return decontamination.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard after shard, each in its local order."""
    mixed = mixing.copies(docs)
    shard, order = mixed.columns[-2:]
    return mixed.repartitionByRange(shard, order).sortWithinPartitions(shard, order).select(*quoted(docs))


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.shard_docs(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_spans),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: Near-duplicates by hashed signatures and the learned toxicity scores are beyond SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
