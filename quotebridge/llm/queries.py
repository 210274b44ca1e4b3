"""One query per operator, over its whole table and with production parameters."""

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebridge.llm import (
    classifier, decontamination, lattice, line_dedup, mixing, periodic_runs, perplexity, piece_encoding, resampling, sharding,
    simhash, suffix_dedup, token_scan,
)
from quotebridge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(table(spark, sf_dir, "documents"))


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.verdicts(table(spark, sf_dir, "documents"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.scored(table(spark, sf_dir, "documents"))


def op6_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_hierarchical_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selection(table(spark, sf_dir, "documents"))


def op8_hashed_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_similar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op10_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a document whose end repeats some of its words, for a tenth of all ids."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    numbers = np.arange(n)
    return np.where(numbers < first, numbers, first + (numbers - first) % period)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), looped)
    greatest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("top", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.l").alias("length"),
        (-F.col("top.p")).alias("period"), F.expr("-(top.l * 1000) div top.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"), "n_words",
    )


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = piece_encoding.encoded(table(spark, sf_dir, "documents"), ["doc_id"])
    texts = piece_encoding.decoded(ids, ["doc_id", "ids"])
    return texts.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_perplexity, op3_virtual_slots, op4_simhash, op5_subword_lattice, op6_edit_matching,
        op7_hierarchical_budget, op8_hashed_ngrams, op9_similar_lines, op10_sparse_suffixes, op11_periodic_runs,
        op12_piece_encoding, op13_importance_resampling,
    )
}
ORACLES: dict[str, str] = {"op7_hierarchical_budget": mixing.ORACLE_SQL}
