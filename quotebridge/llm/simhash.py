"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

Two 64-bit fingerprints that differ in at most 2 bits share at least 6 of their 8 positional bytes. Among any
6 of the 8 positions they then share at least 4, so the index holds, for the first 6 positions, each choice of
4 positional bytes (15 postings a fingerprint). In each posting list the shared positional bytes of a pair
are tallied, pairs below 6 dropped, and the rest verified bit by bit.

Posting lists above ``LIST`` entries (large groups of near copies) are not paired. Their fingerprints are listed
under themselves and their 64 one-bit variants instead: two fingerprints differ in at most 2 bits exactly if
they share a variant, and a variant has at most 65 fingerprints, all linked, so a star to the smallest keeps
every component. Work per fingerprint is bounded by 15 x ``LIST`` + 65 rows either way and no case is dropped.

Defined results: null or blank texts have fingerprint 0 and are linked like any other; repeated rows give
repeated rows; a component whose doc_ids are all null has a null id; an empty table gives no rows; only doc_id and
text are read.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, small_side, staged, tidy
from quotebridge.llm.components import components

SEED = 42
WORDS = 3
BITS = 2
INDEXED, SHARED = 6, 4
LIST = 64


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the text's word shingles, as an unsigned number."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(tokens))
    spans = zip(starts[: len(tokens) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    count = len(tokens) - width + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        bits = np.unpackbits(hashes[at: at + (1 << 16)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, t: hash of the text, fp long): the fingerprint's 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(map(fingerprint, raw_texts(batch["text"])), np.uint64, len(batch))
            yield pa.record_batch({"doc_id": batch["doc_id"], "t": batch["t"], "fp": found.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").mapInArrow(tidy(run), "doc_id long, t long, fp long")


def links(fps: DataFrame, list_size: int = LIST) -> DataFrame:
    """Links (a, b) over distinct fingerprints ``fp`` that keep every component of "at most 2 bits apart"."""
    choices = list(combinations(range(INDEXED), SHARED))
    masks = [sum(255 << (8 * p) for p in choice) for choice in choices]
    postings = fps.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks)
        ])).alias("posting"),
    ).select("fp", "posting.choice", "posting.key")
    sizes = staged(postings.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"), "posting-sizes")
    lists = (
        postings.join(sizes.where(F.col("n") <= list_size), ["choice", "key"])
        .groupBy("choice", "key").agg(F.collect_list("fp").alias("fps"))
    )
    differing = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum(
        (F.shiftrightunsigned(differing, 8 * p).bitwiseAND(F.lit(255)) == 0).cast("int") for p in range(8)
    )
    tallied = (
        lists.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
        .where("a > b").where(shared >= 8 - BITS).where(F.bit_count(differing) <= BITS)
    )
    crowded = postings.join(sizes.where(F.col("n") > list_size), ["choice", "key"]).select("fp").distinct()
    variants = crowded.select(
        F.explode(F.array(*[F.col("fp")] + [
            F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)
        ])).alias("variant"), "fp",
    )
    stars = (
        variants.groupBy("variant").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        .select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a > b")
    )
    return tallied.unionAll(stars)


def near_duplicates(docs: DataFrame, list_size: int = LIST) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of its component)."""
    prints = staged(fingerprints(docs), "fingerprints")
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    labels = components(links(fps.select("fp"), list_size))
    member = fps.join(labels, fps["fp"] == labels["node"]).select("fp", "label", "first")
    firsts = member.groupBy("label").agg(F.min("first").alias("least"))
    linked = member.join(firsts, "label").select("fp", "least")
    ids = staged(
        fps.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "component-ids"
    )  # stored, so that the next join can split a fingerprint that many documents have
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, list_size: int = LIST) -> DataFrame:
    """One row of each component, all columns kept: that of the smallest doc_id, ids before nulls, then of the smallest text hash.

    The choice is made on ids and hashes. Texts are only shuffled where the chosen row itself is repeated.
    """
    prints = staged(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    labels = components(links(staged(prints.select("fp").distinct(), "distinct-fingerprints"), list_size))
    rows = prints.groupBy("doc_id", "t", "fp").agg(F.count("*").alias("n"))
    member = rows.join(labels, rows["fp"] == labels["node"], "left").select(F.coalesce("label", "fp").alias("label"), "doc_id", "t", "n")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "n"))
    chosen = staged(member.groupBy("label").agg(first.alias("first")).select(
        F.col("first.doc_id").alias("chosen_id"), F.col("first.t").alias("chosen_t"), F.col("first.n").alias("n")
    ), "chosen-rows")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # columns of the documents may have any name
    keyed = docs.select(whole.alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t"))

    def rows_of(condition: str) -> DataFrame:
        wanted = small_side(chosen.where(condition)).drop("n")
        return keyed.join(wanted, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("t") == F.col("chosen_t")))

    once, repeated = rows_of("n = 1"), rows_of("n > 1").dropDuplicates(["id", "t"])
    return once.select("row.*").unionByName(repeated.select("row.*"))
