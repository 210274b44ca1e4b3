"""Target-distribution importance resampling over hashed runs of words.

Features of a text are all runs of 1 to ``RUN`` consecutive words; a feature's bucket is its CRC-32 modulo ``buckets``.
Two histograms of that fixed size, of the corpus and of the target, give an array of gains: the scaled logarithm of the
ratio of a bucket's smoothed shares. A document's weight is the sum of gains over its features, its score adds Gumbel
noise hashed from its id, so that the highest scores are a draw without replacement in proportion to the weights.

The draw needs the k-th highest score of the eligible documents. A quantile sketch brackets it; exact counts of the rows
outside validate the bracket or widen it, and only the rows inside are sorted to locate the cutoff. The drawn
rows alone are then sorted by range and numbered. The order is total (score down, doc_id, features, place in the
stored table), so one id that holds a third of all rows is dealt out to many tasks.

Defined results: null texts and texts without a word have no feature and weight 0; a null doc_id counts as an empty id in
the noise and comes last among ties; repeated rows are rows of their own, with ranks of their own; an empty target or corpus
smooths to equal shares; with fewer than 100 / percent eligible rows none is drawn; an empty table gives no
rows; only doc_id and text are read, so other columns may have any name.
"""

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, staged, word_pieces

BUCKETS = 10_000
RUN = 3
SCALE = 1000
SEED = "42"
PERCENT = 5
LEAST_WORDS = 20
#: The sketch's ranks are off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000
#: What remains of each byte: letters in lower case, digits and all bytes beyond ASCII; the rest parts words.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of a text's features, some of them at a time; the first of every ``RUN`` arrays has the single words.

    The checksum of a longer run continues that of the shorter one that starts at the same word.
    """
    before: list[bytes] = []
    for own in word_pieces(text.translate(LETTERS)):
        words = before + own
        spaced = [b" " + word for word in words]
        sums = list(map(crc32, words))
        for run in range(RUN):
            yield np.array(sums[max(0, len(before) - run):], np.int64) % buckets
            sums = list(map(crc32, spaced[run + 1:], sums))
        before = words[1 - RUN:]


def histogram(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket of column ``text``: counted in each task, summed by Spark; ``buckets`` numbers come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in raw_texts(batch["text"]):
                for found in feature_buckets(text, buckets):
                    counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.record_batch({"bucket": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64())})

    result = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        result[row["bucket"]] = row["n"]
    return result


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The array of scores: floor(SCALE * ln of the ratio of smoothed shares) of each bucket."""
    size = len(corpus)
    all_corpus, all_target = int(corpus.sum()) + size, int(target.sum()) + size
    return np.array([
        math.floor(SCALE * math.log((t + 1) * all_corpus / ((s + 1) * all_target)))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ], np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise of a document, scaled, from the first 32 bits of a digest of its id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    share = (int(hashlib.sha256(name.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
    return math.floor(-SCALE * math.log(-math.log(share)))


def scored(docs: DataFrame, table: np.ndarray, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), one row per document."""
    buckets = len(table)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            words, features, weights = (np.zeros(len(batch), np.int64) for _ in range(3))
            for row, text in enumerate(raw_texts(batch["text"])):
                for part, found in enumerate(feature_buckets(text, buckets)):
                    words[row] += 0 if part % RUN else len(found)
                    features[row] += len(found)
                    weights[row] += gain[found].sum()
            drift = np.array([noise(i, seed) for i in batch["doc_id"].to_pylist()], np.int64)
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_words": words, "n_features": features, "weight": weights,
                "score": weights + drift,
            })

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long"
    )


def descending() -> list[Column]:
    """The order of the draw; the first three columns say all that a row of the result shows."""
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("place").asc()]


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``number`` from 0 in a total order: sorted by range, numbered in each part, parts offset by those before."""
    bits = 33  # rows of one part, as monotonically_increasing_id lays them out
    parts = staged(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), name).withColumn(
        "part", F.shiftright("at", bits)
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )  # one row per part
    return parts.join(F.broadcast(offsets), "part").withColumn(
        "number", F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << bits) - 1))
    ).drop("at", "part", "offset")


def bracket(rows: DataFrame, total: int, k: int, margin: float = 2 / ACCURACY) -> tuple[int, int, int]:
    """(low, high, rows above high): the k-th highest of ``total`` scores lies in low to high, which is proven by counts.

    The sketch only proposes; too narrow a bracket is widened, at last to all scores.
    """
    while True:
        ends = [max(0.0, 1 - k / total - margin), min(1.0, 1 - k / total + margin)]
        low, high = rows.agg(F.percentile_approx("score", ends, ACCURACY).alias("ends")).first()["ends"]
        if margin >= 1:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        counts = rows.agg(
            F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("reached")
        ).first()
        if counts["above"] < k <= counts["reached"]:
            return low, high, counts["above"]
        margin *= 8


def cutoff(rows: DataFrame, total: int, k: int, margin: float = 2 / ACCURACY) -> Row:
    """The k-th row in the order of the draw; only the rows of the bracket are sorted."""
    low, high, above = bracket(rows, total, k, margin)
    inside = numbered(rows.where(F.col("score").between(low, high)), descending(), "bracket")
    return inside.where(F.col("number") == k - above - 1).first()


def not_after(last: Row) -> Column:
    """Rows up to ``last`` in the order of the draw."""
    def key(score, missing, doc_id, features, place):
        return F.struct(*(x.cast("long").alias(f"k{i}") for i, x in enumerate((score, missing, doc_id, features, place))))

    own = key(-F.col("score"), F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col("n_features"), F.col("place"))
    missing = last["doc_id"] is None
    return own <= key(
        F.lit(-last["score"]), F.lit(int(missing)), F.lit(0 if missing else last["doc_id"]), F.lit(last["n_features"]),
        F.lit(last["place"]),
    )


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, seed: str = SEED, margin: float = 2 / ACCURACY,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (from 1 for drawn documents, else null), n_words of every document."""
    table = gains(histogram(docs, buckets), histogram(target, buckets))
    rows = staged(scored(docs, table, seed).withColumn("place", F.monotonically_increasing_id()), "scored")
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    eligible = rows.where(F.col("n_words") >= least_words)
    total = eligible.count()
    k = percent * total // 100
    if not k:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    drawn = (F.col("n_words") >= least_words) & not_after(cutoff(eligible, total, k, margin))
    ranked = numbered(rows.where(drawn), descending(), "drawn").withColumn("rank", F.col("number") + 1)
    return rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(*columns).unionByName(ranked.select(*columns))
