"""Periodic runs of words: maximal stretches that repeat a period at least ``TIMES`` times.

A run has a smallest period q (words q apart are identical), at least max(``LEAST``, ``TIMES`` * q) words, and no neighbouring
word extends it with that period. Its matches, the words that equal the word q further on, are a stretch of at least
3 q words.

Scale-tiled distribution. The octave of block size B has the periods B to 2 B - 1. A document is cut into blocks of B words per octave;
the matches of a run hold two whole neighbouring blocks, and every word of those occurs again less than 2 B words on.
Blocks where that holds (a maximum per block, doubled from octave to octave) are exploded into overlapping tiles: the
block, B words before it and 3 B after it. All other blocks provably hold no run. Tiles are solved independently, wherever they
lie: the Z-function of the words from the block's start gives the matches of all periods to the right, that of the
reversed words to the left. The fragments are shuffled by document and period, and overlapping ones are stitched; a run
of any length is found so, and a very long document is solved by many tasks. Periods that are powers of a shorter word are
dropped in the tile.

Documents without a tile are finished by the pass that looks for tiles and are not stored or shuffled.

Defined results: null, empty and blank texts have 0 words and no run; a repeated row is a document of its own (rows have keys
of their own); a null doc_id is kept; words are compared as bytes; an empty table gives no rows; only doc_id
and text are read, so other columns may have any name.
"""

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, staged, word_pieces

LEAST = 6
TIMES = 4

#: Word numbers to read instead of 0 to n - 1, from doc_id and n; None leaves a document as it is.
Arrange = Callable[[int | None, int], np.ndarray | None]
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def numbered_words(text: bytes, doc_id: int | None = None, arrange: Arrange | None = None) -> tuple[np.ndarray, list[bytes]]:
    """Each word as a number in order of first occurrence, and the distinct words."""
    known: dict[bytes, int] = {}
    parts = [np.empty(0, np.int32)]
    for words in word_pieces(text):
        parts.append(np.array([known.setdefault(word, len(known)) for word in words], np.int32))
    numbers = np.concatenate(parts)
    order = arrange(doc_id, len(numbers)) if arrange else None
    return numbers if order is None else numbers[order], list(known)


def joined(numbers: np.ndarray, names: list[bytes]) -> bytes:
    """The words of a document, joined by one space."""
    return b" ".join(map(names.__getitem__, numbers.tolist()))


def gaps(numbers: np.ndarray) -> np.ndarray:
    """Distance from each word to its next occurrence; words that don't occur again have the document's length."""
    order = np.argsort(numbers, kind="stable")
    found = np.full(len(numbers), len(numbers), np.int64)
    again = np.flatnonzero(numbers[order[1:]] == numbers[order[:-1]])
    found[order[again]] = order[again + 1] - order[again]
    return found


def tiles(numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    """(block size, block's start) of all blocks that a run's matches may fill, octave by octave."""
    widest = gaps(numbers)
    block = 1
    while block * TIMES <= len(numbers):
        open_ = widest < 2 * block
        if open_.any():
            beside = np.zeros(len(open_), bool)
            beside[1:] |= open_[:-1]
            beside[:-1] |= open_[1:]
            for at in np.flatnonzero(open_ & beside).tolist():
                yield block, at * block
        widest = widest[: len(widest) // 2 * 2].reshape(-1, 2).max(axis=1)
        block *= 2


def z_function(words: list[int]) -> list[int]:
    """For each place the length of the longest common prefix of the words and the words from there on."""
    n = len(words)
    z = [n] + [0] * (n - 1) if n else []
    left = right = 0
    for i in range(1, n):
        size = min(right - i, z[i - left]) if i < right else 0
        while i + size < n and words[size] == words[i + size]:
            size += 1
        if i + size > right:
            left, right = i, i + size
        z[i] = size
    return z


def solved(words: list[int], before: int, block: int) -> list[tuple[int, int, int]]:
    """(period, matches before the block's start, matches from there on) for the periods of the octave that fill the block.

    The block starts at ``before``. Periods whose word is a power of a shorter one are left out: the shorter period has
    the same stretch.
    """
    ahead = z_function(words[before:])
    periods = [q for q in range(block, min(2 * block, len(ahead))) if ahead[q] >= block]
    if not periods:
        return []
    powers: set[int] = set()
    for q in range(1, periods[-1] // 2 + 1):
        if ahead[q] >= q and q not in powers:
            powers.update(range(2 * q, min(ahead[q] + q, periods[-1]) + 1, q))
    periods = [q for q in periods if q not in powers]
    back = words[:before][::-1]
    # matches of the words before the block with those before block + q: the reversed words from there on
    behind = z_function([*back, -1, *words[: before + 2 * block - 1][::-1]])
    end = before + 1 + len(words[: before + 2 * block - 1])
    return [(q, min(before, behind[end - before - q]), ahead[q]) for q in periods]


def exploded(keyed: DataFrame, arrange: Arrange | None = None) -> DataFrame:
    """Rows of the documents that have tiles: one with block 0 and the text, one per tile with its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("text", pa.string()),
            ("block", pa.int64()), ("start", pa.int64()), ("lead", pa.int64()), ("words", pa.binary()),
        ])
        for batch in batches:
            rows, held = [], 0
            for key, doc_id, text in zip(batch["key"].to_pylist(), batch["doc_id"].to_pylist(), raw_texts(batch["text"]), strict=True):
                numbers, names = numbered_words(text, doc_id, arrange)
                first = True
                for block, at in tiles(numbers):
                    if first:
                        rows.append((key, doc_id, len(numbers), joined(numbers, names), 0, 0, 0, None))
                        held, first = held + len(text), False
                    lead = min(block, at)
                    words = numbers[at - lead: at + 4 * block].tobytes()
                    rows.append((key, doc_id, None, None, block, at, lead, words))
                    held += len(words)
                    if held > 1 << 22 or len(rows) > 10_000:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return keyed.mapInArrow(
        run, "key long, doc_id long, n_words long, text string, block long, start long, lead long, words binary"
    )


def finished(docs: DataFrame, arrange: Arrange | None = None) -> DataFrame:
    """(doc_id, n_words, kept_text) of the documents without any tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                rows = []
                for doc_id, text in zip(part["doc_id"].to_pylist(), raw_texts(part["text"]), strict=True):
                    numbers, names = numbered_words(text, doc_id, arrange)
                    if next(tiles(numbers), None) is None:
                        rows.append((doc_id, len(numbers), joined(numbers, names)))
                ids, sizes, texts = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.record_batch({
                    "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()), "kept_text": pa.array(texts, pa.string()),
                })

    return docs.mapInArrow(run, "doc_id long, n_words long, kept_text string")


def fragments(tiled: DataFrame) -> DataFrame:
    """(key, period, first, end): stretches of matches that each tile sees, ends clipped to the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch[c].to_pylist() for c in ("key", "block", "start", "lead"))
            for (key, block, start, lead), words in zip(zip(*columns, strict=True), batch["words"], strict=True):
                numbers = np.frombuffer(words.as_buffer(), np.int32).tolist()
                rows += [(key, q, start - back, start + ahead) for q, back, ahead in solved(numbers, lead, block)]
            key, period, first, end = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.record_batch({
                "key": pa.array(key, pa.int64()), "period": pa.array(period, pa.int64()), "first": pa.array(first, pa.int64()),
                "end": pa.array(end, pa.int64()),
            })

    return tiled.select("key", "block", "start", "lead", "words").mapInArrow(run, "key long, period long, first long, end long")


def stitched(parts: DataFrame) -> DataFrame:
    """(key, start, length, period) of the runs: fragments of one document and period that overlap or touch are one stretch."""
    order = Window.partitionBy("key", "period").orderBy("first", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = parts.withColumn("opens", (F.coalesce(reached, F.lit(-1)) < F.col("first")).cast("long")).withColumn(
        "island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = islands.groupBy("key", "period", "island").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    return whole.select("key", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))
    )


def collapsed(rows: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) from (doc_id, n_words, text, runs): of each run, the first period remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for n, text, runs in zip(batch["n_words"].to_pylist(), raw_texts(batch["text"]), batch["runs"].to_pylist(), strict=True):
                kept = np.ones(n, bool)
                for one in runs:
                    kept[one["start"] + one["period"]: one["start"] + one["length"]] = False
                at, parts = 0, []
                for words in word_pieces(text):
                    own = b" ".join(compress(words, kept[at: at + len(words)]))
                    at += len(words)
                    parts += [own] if own else []
                texts.append(b" ".join(parts))
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_words": batch["n_words"], "runs": batch["runs"], "kept_text": pa.array(texts, pa.string()),
            })

    return rows.select("doc_id", "n_words", "text", "runs").mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, kept_text string"
    )


def periodic_runs(docs: DataFrame, arrange: Arrange | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period), kept_text of every document."""
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    rows = staged(exploded(plain.withColumn("key", F.monotonically_increasing_id()), arrange), "period-tiles", "zstd")
    runs = stitched(fragments(rows.where("block > 0")))
    listed = runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found")).select(
        "key", F.transform("found", lambda r: F.struct(*(r[c].alias(c) for c in ("start", "length", "period")))).alias("runs")
    )
    none = F.array().cast(RUNS)
    tiled = rows.where("block = 0").select("key", "doc_id", "n_words", "text").join(listed, "key", "left").withColumn(
        "runs", F.coalesce("runs", none)
    )
    return finished(plain, arrange).select("doc_id", "n_words", none.alias("runs"), "kept_text").unionByName(collapsed(tiled))
