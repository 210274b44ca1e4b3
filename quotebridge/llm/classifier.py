"""Quality classifier: logistic regression over hashed word n-grams, fitted by follow-the-regularised-leader updates.

Features of a text, hashed into ``WIDTH`` places: its folded words, their pairs, and the shapes of the words (letters as
"a", digits as "0", runs once, "=" for a word that equals the one before) with their pairs, as junk often is made of
words that were never seen before. Each of the four kinds counts as shares of its own total. A score is the
logistic function of a sparse dot product plus a bias.

Fitting uses at most ``SAMPLE`` labelled documents, those of the smallest hash of doc_id; only their ids are broadcast. The
sample is dealt over one task for each ``PART_ROWS`` of its bound. In each epoch every task starts from the shared state and runs the per-coordinate
updates over its rows; Spark then averages, per coordinate, the states of the tasks that touched it. State and
weights have ``WIDTH`` entries whatever the data, so the driver holds no more. All documents are scored.

Defined results: null and blank texts score the bias alone; rows without a doc_id count as crc32 of empty text for
the split; documents labelled more than once are learned with their mean label; repeated rows give repeated rows; without
any usable label all scores are 0.5; an empty table gives no rows; only doc_id and text are read.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, staged

WIDTH = 1 << 18
SAMPLE = 20_000
#: Rows of a fitting task; the number of tasks follows the sample.
PART_ROWS, EPOCHS = 2_500, 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-3
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
#: Words that a task remembers the hashes of, and the longest of them; a longer word is hashed again where it occurs again.
REMEMBERED, LONGEST = 300_000, 64

RUNS = (
    (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0"), (re.compile(rb"([^a0])\1+"), rb"\1"),
)


class Places(dict):
    """Word -> (hash of the word, hash of its shape), filled as words come."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        shape = word
        for pattern, by in RUNS:
            shape = pattern.sub(by, shape)
        found = (xxhash.xxh32_intdigest(word), xxhash.xxh32_intdigest(shape, 1))
        if len(word) <= LONGEST:
            self[word] = found
        return found


SAME = xxhash.xxh32_intdigest(b"=", 1)


def features(text: bytes, places: Places) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features; a place may occur more than once."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    hashes = np.array([places[w] for w in words], np.uint64)
    word, shape = hashes[:, 0], hashes[:, 1].copy()
    shape[1:][word[1:] == word[:-1]] = SAME
    kinds = [word, word[:-1] * np.uint64(0x9E3779B1) + word[1:] * np.uint64(0x85EBCA77) + np.uint64(1)]
    kinds += [shape, shape[:-1] * np.uint64(0xC2B2AE3D) + shape[1:] * np.uint64(0x27D4EB2F) + np.uint64(2)]
    kinds = [k for k in kinds if len(k)]
    mixed = np.concatenate(kinds)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    at = ((mixed >> np.uint64(32)) % np.uint64(WIDTH)).astype(np.int64)
    return at, np.concatenate([np.full(len(k), 1 / len(k)) for k in kinds])


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def update(z: np.ndarray, n: np.ndarray, at: np.ndarray, values: np.ndarray, label: float) -> None:
    """One follow-the-regularised-leader step; ``at`` has no place twice."""
    own = weights(z[at], n[at])
    gradient = (logistic(own @ values) - label) * values
    grown = n[at] + gradient * gradient
    z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * own
    n[at] = grown


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def parts_of(sample: int) -> int:
    return max(1, -(-sample // PART_ROWS))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(part, place_in_part, label, at, values) of the sampled labelled documents, stored."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != HELD_OUT))
    picked = staged(
        usable.groupBy(F.col("doc_id").alias("id")).agg(F.avg(F.col("quality").cast("double")).alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample), "picked-labels",
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places()
        for whole in batches:
            for start in range(0, len(whole), 256):
                batch = whole.slice(start, 256)
                at, values = [], []
                for text in raw_texts(batch["text"]):
                    found, share = features(text, places)
                    own, back = np.unique(found, return_inverse=True)
                    at.append(np.append(own, WIDTH))
                    values.append(np.append(np.bincount(back, share, len(own)), 1.0))
                yield pa.record_batch({
                    "id": batch["id"], "label": batch["label"],
                    "at": pa.array(at, pa.list_(pa.int32())), "vals": pa.array(values, pa.list_(pa.float64())),
                })

    rows = texts.select("id", "label", "text").mapInArrow(run, "id long, label double, at array<int>, vals array<double>")
    return staged(rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts_of(sample))).cast("int")), "training-rows")


def fitted(rows: DataFrame, epochs: int = EPOCHS, parts: int = 8) -> np.ndarray:
    """The weights; the last one is the bias."""
    spark = rows.sparkSession
    z, n = np.zeros(WIDTH + 1), np.zeros(WIDTH + 1)
    for epoch in range(epochs):
        state = spark.sparkContext.broadcast((z, n))

        def run(key: tuple, tables: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            z, n = state.value[0].copy(), state.value[1].copy()
            touched = np.zeros(len(z), bool)
            for batch in tables:
                labels = batch["label"].to_numpy()
                for i in range(len(batch)):
                    at = batch["at"][i].values.to_numpy()
                    update(z, n, at, batch["vals"][i].values.to_numpy(), labels[i])
                    touched[at] = True
            found = np.flatnonzero(touched)
            yield pa.record_batch({"place": found, "z": z[found], "n": n[found]})

        order = F.xxhash64("id", F.lit(epoch + 2))
        dealt = rows.repartition(parts, "part").sortWithinPartitions("part", order, "id")

        def each(batches: Iterator[pa.RecordBatch], run=run) -> Iterator[pa.RecordBatch]:
            yield from run((), (b for b in batches if len(b)))

        merged = dealt.select("label", "at", "vals").mapInArrow(each, "place long, z double, n double").groupBy("place").agg(
            F.avg("z").alias("z"), F.avg("n").alias("n")
        ).toArrow()
        at = merged["place"].to_numpy()
        z, n = z.copy(), n.copy()
        z[at], n[at] = merged["z"].to_numpy(), merged["n"].to_numpy()
        state.unpersist()
    return weights(z, n)


def scored(docs: DataFrame, found: np.ndarray) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, places = shared.value, Places()
        for batch in batches:
            sums = np.empty(len(batch))
            for i, text in enumerate(raw_texts(batch["text"])):
                at, values = features(text, places)
                sums[i] = model[at] @ values + model[WIDTH]
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": logistic(sums)})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    found = fitted(training_rows(docs, labels, sample), epochs, parts_of(sample))
    return scored(docs, found).select(
        "doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
