"""Corpus pipeline: documents through the training-data stages, each a (spark, docs, sf_dir) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotebridge.llm import decontamination, mixing, perplexity, sharding, simhash
from quotebridge.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or leave the perplexity band of their language go."""
    return perplexity.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a mixture to target weights stay, each once."""
    return mixing.mixed(docs)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its virtual slot and its shard."""
    return sharding.assigned(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("shard_assignment", shard_assignment),
]
#: The n-gram model and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
