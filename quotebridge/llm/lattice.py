"""Language-model scores from a subword lattice: the probability of a text summed over all its segmentations.

The pieces are those of an existing vocabulary; blanks part words, each word starts with the vocabulary's word mark, and no
piece spans two words, so the marginal of a text is the product of those of its words and of its end. Byte pieces
make every text possible. The vocabulary at hand carries merge ranks as scores, not probabilities, so the first weights are
1 / (rank + ``OFFSET``); ``ROUNDS`` rounds of expected piece counts over the training words turn them into a unigram
model. Words are counted over all documents by Spark, and each distinct word meets the lattice once per round, in blocks of
words of one length, by a forward (and for expected counts backward) recursion in log space. Words of over ``LONG`` bytes
go alone, ``SPAN`` places at a time: a text of many megabytes without blanks takes two numbers a byte and no more edges than a span has.

Words with at most 1/``COMMON`` of the training tokens are joined to the documents by shuffle; there are at most
``COMMON`` more frequent ones, and only those are broadcast.

Defined results: null text is an empty text: the end alone; a null doc_id counts as crc32 of empty text; without training
documents base scores use zero counts and the lattice its first weights; repeated rows give repeated rows; an empty
table gives no rows; only doc_id and text are read.
"""

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, staged

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
COMMON = 100_000
OFFSET, SMOOTHING, ROUNDS = 10.0, 0.1, 2
MARK = "▁".encode()
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words that a counting task holds before it passes them on.
HELD = 400_000
CELLS = 4_000_000
#: Bytes, with the mark, up to which words meet the lattice in blocks; places of a longer word whose edges are held at once.
LONG, SPAN = 256, 1 << 16


class Pieces:
    """Surfaces of the pieces as sorted hashes, with their natural log probabilities."""

    def __init__(self, surfaces: list[bytes], weights: list[float], end: float):
        merged: dict[bytes, float] = defaultdict(float)
        for surface, weight in zip(surfaces, weights, strict=True):
            merged[surface] += weight
        names = sorted(merged)
        hashes = np.array([int(_hash(np.frombuffer(s, np.uint8)[None, :])[0]) for s in names], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.names = [names[i] for i in order]
        self.longest = max(map(len, names))
        values = np.array([merged[s] for s in self.names])
        total = values.sum() + end
        self.logs = np.log(values / total)
        self.end = float(np.log(end / total))

    @classmethod
    def of(cls, state: dict) -> "Pieces":
        """From what vars() gives: a broadcast carries the plain state, as executors may lack this module."""
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made


def _hash(rows: np.ndarray) -> np.ndarray:
    found = np.zeros(len(rows), np.uint64)
    for k in range(rows.shape[1]):
        found = found * BASE + rows[:, k].astype(np.uint64) + np.uint64(1)
    return found


def read_pieces(path: str) -> Pieces:
    """Usable pieces of a vocabulary file: those without a word mark inside; controls and the unknown are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain, bytes_ = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        if model.is_byte(i):
            bytes_.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
        elif MARK not in (surface := model.id_to_piece(i).encode())[1:]:
            plain.append((model.get_score(i), surface))
    plain.sort(key=lambda x: (-x[0], x[1]))
    surfaces = [s for _, s in plain] + bytes_
    return Pieces(surfaces, [1 / (i + OFFSET) for i in range(len(surfaces))], 1 / OFFSET)


def _edges(pieces: Pieces, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, stop, rows of the block with a piece there, places of the pieces), by stop."""
    m, n = rows.shape
    prefix = np.zeros((m, n + 1), np.uint64)
    for k in range(n):
        prefix[:, k + 1] = prefix[:, k] * BASE + rows[:, k].astype(np.uint64) + np.uint64(1)
    powers = [np.uint64(1)]
    with np.errstate(over="ignore"):
        for _ in range(min(n, pieces.longest)):
            powers.append(powers[-1] * BASE)
    last = len(pieces.hashes) - 1
    for stop in range(1, n + 1):
        for length in range(1, min(stop, pieces.longest) + 1):
            wanted = prefix[:, stop] - prefix[:, stop - length] * powers[length]
            at = np.minimum(np.searchsorted(pieces.hashes, wanted), last)
            hit = np.flatnonzero(pieces.hashes[at] == wanted)
            if len(hit):
                yield stop - length, stop, hit, at[hit]


def _forward(pieces: Pieces, rows: np.ndarray, edges: list) -> np.ndarray:
    alpha = np.full((len(rows), rows.shape[1] + 1), -np.inf)
    alpha[:, 0] = 0.0
    for start, stop, hit, at in edges:
        alpha[hit, stop] = np.logaddexp(alpha[hit, stop], alpha[hit, start] + pieces.logs[at])
    return alpha


class LongWords:
    """The recursions along one word, with the edges of all places of a span found together."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.filled = np.zeros(1 << 20, bool)
        self.filled[pieces.hashes >> np.uint64(44)] = True

    def edges(self, letters: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, stops, places of the pieces) of the edges with low < stop <= high, by stop."""
        pieces = self.pieces
        first = max(0, low + 1 - pieces.longest)
        own = letters[first:high].astype(np.uint64) + np.uint64(1)
        starts, stops, places = [], [], []
        hashes = np.zeros(len(own) + 1, np.uint64)
        for length in range(1, min(pieces.longest, len(own)) + 1):
            hashes = hashes[:-1] * BASE + own[length - 1:]
            # most places have no piece: a table of the hashes' first bits tells before the search
            new = max(0, low + 1 - first - length)
            maybe = np.flatnonzero(self.filled[hashes[new:] >> np.uint64(44)]) + new
            at = np.minimum(np.searchsorted(pieces.hashes, hashes[maybe]), len(pieces.hashes) - 1)
            hit = pieces.hashes[at] == hashes[maybe]
            starts.append(first + maybe[hit])
            stops.append(starts[-1] + length)
            places.append(at[hit])
        stop = np.concatenate(stops)
        order = np.argsort(stop, kind="stable")
        return np.concatenate(starts)[order], stop[order], np.concatenate(places)[order]

    def forward(self, letters: np.ndarray) -> np.ndarray:
        """Log probability of each prefix."""
        alpha = np.full(len(letters) + 1, -np.inf)
        alpha[0] = 0.0
        for low in range(0, len(letters), SPAN):
            high = min(low + SPAN, len(letters))
            starts, stops, at = self.edges(letters, low, high)
            first = max(0, low + 1 - self.pieces.longest)
            own = alpha[first:high + 1].tolist()
            for start, stop, log in zip((starts - first).tolist(), (stops - first).tolist(), self.pieces.logs[at].tolist(), strict=True):
                own[stop] = _added(own[stop], own[start] + log)
            alpha[low + 1:high + 1] = own[low + 1 - first:]
        return alpha

    def expected(self, letters: np.ndarray, count: float) -> np.ndarray:
        """Expected number of times that each piece occurs in ``count`` copies of the word."""
        total = np.zeros(len(self.pieces.logs))
        alpha = self.forward(letters)
        beta = np.full(len(letters) + 1, -np.inf)
        beta[-1] = 0.0
        weight = np.log(count) - alpha[-1]
        for low in reversed(range(0, len(letters), SPAN)):
            high = min(low + SPAN, len(letters))
            starts, stops, at = self.edges(letters, low, high)
            logs = self.pieces.logs[at]
            first = max(0, low + 1 - self.pieces.longest)
            own = beta[first:high + 1].tolist()
            back = zip((starts - first)[::-1].tolist(), (stops - first)[::-1].tolist(), logs[::-1].tolist(), strict=True)
            for start, stop, log in back:
                own[start] = _added(own[start], own[stop] + log)
            beta[first:high + 1] = own
            total += np.bincount(at, np.exp(alpha[starts] + logs + beta[stops] + weight), len(total))
        return total


def _added(a: float, b: float) -> float:
    """log(exp(a) + exp(b)) of two numbers."""
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def _long(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(place, bytes with the mark before them) of the words that go alone."""
    for i, word in enumerate(words):
        if len(word) + len(MARK) > LONG:
            yield i, np.frombuffer(MARK + word, np.uint8)


def _blocks(words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """The other words with the mark before them, grouped by length: (their places, matrix of bytes)."""
    groups: dict[int, list[int]] = defaultdict(list)
    for i, word in enumerate(words):
        if len(word) + len(MARK) <= LONG:
            groups[len(word)].append(i)
    for length, own in groups.items():
        width = length + len(MARK)
        step = max(1, CELLS // (width * 16))
        for at in range(0, len(own), step):
            part = own[at: at + step]
            joined = b"".join(MARK + words[i] for i in part)
            yield part, np.frombuffer(joined, np.uint8).reshape(len(part), width)


def word_logs(pieces: Pieces, words: list[bytes]) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    found = np.empty(len(words))
    for own, rows in _blocks(words):
        found[own] = _forward(pieces, rows, _edges(pieces, rows))[:, -1]
    alone = LongWords(pieces)
    for i, letters in _long(words):
        found[i] = alone.forward(letters)[-1]
    return found


def expected_pieces(pieces: Pieces, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected number of times that each piece occurs in the words, each taken ``counts`` times."""
    total = np.zeros(len(pieces.logs))
    for own, rows in _blocks(words):
        edges = list(_edges(pieces, rows))
        alpha = _forward(pieces, rows, edges)
        beta = np.full_like(alpha, -np.inf)
        beta[:, -1] = 0.0
        weight = np.log(counts[own]) - alpha[:, -1]
        for start, stop, hit, at in reversed(edges):
            path = pieces.logs[at] + beta[hit, stop]
            beta[hit, start] = np.logaddexp(beta[hit, start], path)
            total += np.bincount(at, np.exp(alpha[hit, start] + path + weight[hit]), len(total))
    alone = LongWords(pieces)
    for i, letters in _long(words):
        total += alone.expected(letters, counts[i])
    return total


# --- over documents --------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n): every distinct word of the documents and how often the training ones hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            found = pa.record_batch({"word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return found

        for batch in batches:
            for out, text in zip(batch["out"].to_pylist(), raw_texts(batch["text"]), strict=True):
                words = text.lower().split()
                if out:
                    for word in words:
                        held[word] += 0
                else:
                    held.update(words)
                if len(held) > HELD:
                    yield flush()
        yield flush()

    found = docs.select(held_out(F.col("doc_id")).alias("out"), "text").mapInArrow(run, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def reweighted(words: DataFrame, pieces: Pieces, ends: int) -> Pieces:
    """One round: expected counts of the pieces over the stored training words, as the next weights."""
    shared = words.sparkSession.sparkContext.broadcast(vars(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces.of(shared.value)
        total = np.zeros(len(own.logs))
        for batch in batches:
            if len(batch):
                total += expected_pieces(own, batch["word"].to_pylist(), batch["n"].to_numpy())
        at = np.flatnonzero(total)
        yield pa.record_batch({"place": at, "n": total[at]})

    found = words.where("n > 0").mapInArrow(run, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    weights = np.full(len(pieces.names), SMOOTHING)
    weights[found["place"].to_numpy()] += found["n"].to_numpy()
    return Pieces(pieces.names, weights.tolist(), ends + SMOOTHING)


def scored_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, log10 of its marginal probability)."""
    shared = words.sparkSession.sparkContext.broadcast(vars(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces.of(shared.value)
        for batch in batches:
            logs = word_logs(own, batch["word"].to_pylist()) / np.log(10)
            yield pa.record_batch({"word": batch["word"], "n": batch["n"], "marginal": logs})

    return words.mapInArrow(run, "word binary, n long, marginal double")


def split_documents(docs: DataFrame, common: dict[bytes, tuple[int, float, float]]) -> DataFrame:
    """One row per document: row, doc_id, n_tokens, sums over its common words and the rest as (word, times)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = shared.value
        row = 0
        for whole in batches:
            for start in range(0, len(whole), 512):
                batch = whole.slice(start, 512)
                sums, names, times, offsets = [], [], [], [0]
                for text in raw_texts(batch["text"]):
                    words = Counter(text.lower().split())
                    known, base, marginal = 0, 0.0, 0.0
                    for word, n in words.items():
                        entry = known_words.get(word)
                        if entry is None:
                            names.append(word)
                            times.append(n)
                        else:
                            known += n
                            base += n * entry[0]
                            marginal += n * entry[1]
                    offsets.append(len(names))
                    sums.append((row, words.total() + 1, known, base, marginal))
                    row += 1
                columns = [pa.array(c) for c in zip(*sums, strict=True)]
                rest = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(times, pa.int64())], ["word", "times"]),
                )
                yield pa.record_batch(
                    [batch["doc_id"], *columns, rest], names=["doc_id", "row", "n_tokens", "known", "base", "marginal", "rest"]
                )

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, row long, n_tokens long, known long, base double, marginal double, rest array<struct<word: binary, times: long>>"
    )
    return found.withColumn("row", F.spark_partition_id().cast("long") * F.lit(1 << 40) + F.col("row"))


def scored(docs: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, common: int = COMMON) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    words = staged(word_counts(docs), "words")
    ends = docs.where(~held_out(F.col("doc_id"))).count()
    counted = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, distinct = counted["n"] + ends, counted["v"] + (ends > 0)

    def base(c: Column) -> Column:
        return F.log10((c + 1) / F.lit(float(total + distinct + 1)))

    pieces = read_pieces(vocabulary)
    for _ in range(rounds if counted["n"] else 0):
        pieces = reweighted(words, pieces, ends)
    table = staged(scored_words(words, pieces).withColumn("base", base(F.col("n"))), "scored-words")
    frequent = table.where((F.col("n") > 0) & (F.col("n") * common > total)).select("word", "base", "marginal")  # fewer than ``common`` rows
    parts = staged(split_documents(docs, {bytes(w): (b, m) for w, b, m in frequent.collect()}), "split-documents")
    rest = parts.select("row", F.explode("rest").alias("one")).select("row", "one.word", "one.times").join(
        table.select("word", "n", F.col("base").alias("b"), F.col("marginal").alias("m")), "word"
    ).groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("k"),
        F.sum(F.col("times") * F.col("b")).alias("b"), F.sum(F.col("times") * F.col("m")).alias("m"),
    )
    end_base = float(np.log10((ends + 1) / (total + distinct + 1)))
    zero = F.lit(0)
    return parts.drop("rest").join(rest, "row", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("k", zero) + int(ends > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero) + end_base).alias("base_score"),
        (F.col("marginal") + F.coalesce("m", zero) + pieces.end / float(np.log(10))).alias("score"),
    )
