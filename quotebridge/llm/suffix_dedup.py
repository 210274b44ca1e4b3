"""Passages that repeat across documents or inside one, by sparse suffix arrays.

Texts are word sequences. Of all suffixes only those that begin at a minimiser are kept: of each ``WINDOW`` consecutive
grams of ``GRAM`` words the one with the least hash, chosen by content alone, so a passage of ``LEAST`` = 50 words has the
same one wherever it stands. Grams that occur once are dropped before anything wide is made. The others carry hashes of the
``REACH`` words to their right and left, are sorted over the cluster by gram, right words and left words, and each is compared
with the other suffixes of its gram: common right words plus common left words give the match, and matches of 50 words or more
hold passages of 50 words.

Grams with more than ``MATES`` + 1 suffixes are not compared in pairs: every passage of 50 words around such a gram is hashed, and
equal hashes are matches. That is linear in the rows, and combined before it is shuffled. Both ways give, for every passage of
50 words, the same two places: the least and the greatest of all places (text, word) that hold it. So ``MATES`` decides
about cost only.

The partner of a passage is the text of its least place, and for the least place itself the text of the greatest. So all holders
name one text and meet there. Overlapping and touching passages with one partner are joined, so longer ones come out
whole; passages with different partners stay apart. ``keeps`` marks the least places: cutting all other spans leaves each
passage once. With ``inside`` false, places of one text are one place and only repeats across texts are found.

Equal texts are one text (by a 64-bit hash); their documents share its spans, and if they have 50 words or more the whole text is
one more, marked as a copy. Words are compared by 32-bit hashes, grams by 64-bit ones.

Defined results: null, blank and short texts have no span; documents without doc_id take part
and are reported with a null doc_id; repeated rows give repeated rows; an empty table gives no rows; only doc_id and text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, small_side, staged

LEAST = 50
GRAM, WINDOW = 8, 32
REACH = LEAST - GRAM
REMEMBERED = 300_000
CHUNK = 50_000
MATES = 16
LAST = (1 << 63) - 1
#: Places that are broadcast to the texts, at most; more of them are joined by shuffle.
LIGHT = 100_000
MATCH = "t long, start long, stop long, other long, keeps boolean"


class WordHashes(dict):
    """Word -> 32-bit hash, never 0."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh32_intdigest(word) or 1
        return found


def grams_of(hashes: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of each run of ``GRAM`` words."""
    count = len(hashes) - GRAM + 1
    found = np.zeros(count, np.uint64)
    for k in range(GRAM):
        found = found * np.uint64(0x9E3779B97F4A7C15) + hashes[k: k + count].astype(np.uint64)
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(29))


def minimisers(grams: np.ndarray) -> np.ndarray:
    """Places of the least gram of each window, the first of equals."""
    return np.unique(least_of_windows(grams))


def least_of_windows(grams: np.ndarray) -> np.ndarray:
    """The place of the least gram of each window; it never goes down from window to window."""
    views = np.lib.stride_tricks.sliding_window_view(grams, min(WINDOW, len(grams)))
    places = [views[at: at + CHUNK].argmin(axis=1) + np.arange(at, min(at + CHUNK, len(views))) for at in range(0, len(views), CHUNK)]
    return np.concatenate(places)


def anchored(grams: np.ndarray) -> np.ndarray:
    """Minimisers as one number each: place, words from its first window's start, words from its last window's start.

    A minimiser stands for a passage only if one of its windows lies inside the passage. That depends on the words of the passage
    alone, so it holds for all places of the passage or for none, whatever stands around them.
    """
    least = least_of_windows(grams)
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    last = np.append(first[1:], len(least)) - 1
    place = least[first]
    return (place * WINDOW + place - first) * WINDOW + place - last


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, fewest, most words before it) at which passages begin that the minimiser stands for."""
    place, back, near = codes // WINDOW ** 2, codes // WINDOW % WINDOW, codes % WINDOW
    return place, near, np.minimum(REACH, back + LEAST - GRAM + 1 - WINDOW)


def word_hashes(text: bytes, known: WordHashes) -> np.ndarray:
    words = text.split()
    return np.fromiter((known[w] for w in words), np.uint32, len(words))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(t, first, last, times, words): one row per distinct text with the least and greatest doc_id, stored."""
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    text = F.coalesce(F.col("text"), F.lit(""))
    return staged(
        docs.select(ids.alias("id"), F.xxhash64(text).alias("t"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
        .groupBy("t").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("times"), F.max("n").alias("words")),
        "distinct-texts",
    )


def representatives(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(t, text) of one document per distinct text of 50 words or more."""
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    own = docs.where("text IS NOT NULL").select(ids.alias("first"), F.xxhash64("text").alias("t"), "text")
    chosen = small_side(texts.where(F.col("words") >= LEAST).select("t", "first"))
    return own.join(chosen, ["t", "first"], "left_semi").select("t", "text")


def anchors(texts: DataFrame) -> DataFrame:
    """(gram, t, pos) of every minimiser, ``pos`` as ``anchored`` packs it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for whole in batches:
            for first in range(0, len(whole), 512):
                batch = whole.slice(first, 512)
                found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
                for t, text in zip(batch["t"].to_pylist(), raw_texts(batch["text"]), strict=True):
                    hashes = word_hashes(text, known)
                    if len(hashes) >= LEAST:
                        grams = grams_of(hashes)
                        codes = anchored(grams)
                        found.append((grams[unpacked(codes)[0]].view(np.int64), np.full(len(codes), t), codes))
                gram, t, pos = map(np.concatenate, zip(*found, strict=True))
                yield pa.record_batch({"gram": gram, "t": t, "pos": pos})

    return texts.mapInArrow(run, "gram long, t long, pos long")


def sides(hashes: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes to the right and, backwards, to the left of the grams at the given places; 0 outside of the text."""
    steps = np.arange(REACH)
    padded = np.concatenate([np.zeros(REACH, np.uint32), hashes, np.zeros(REACH + GRAM, np.uint32)]).astype(">u4")
    return padded[REACH + GRAM + pos[:, None] + steps], padded[REACH - 1 + pos[:, None] - steps]


def passages_at(hashes: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, starts) of all passages of 50 words that the given minimisers stand for, each once, some at a time."""
    edges = np.zeros(len(hashes) + 1, np.int64)
    place, fewest, most = unpacked(codes)
    np.add.at(edges, np.maximum(place - most, 0), 1)
    np.add.at(edges, place - fewest + 1, -1)
    starts = np.flatnonzero(np.cumsum(edges)[: len(hashes) - LEAST + 1] > 0)
    for first in range(0, len(starts), CHUNK):
        own = starts[first: first + CHUNK]
        key = np.zeros(len(own), np.uint64)
        for k in range(LEAST):
            key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[own + k].astype(np.uint64)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        yield (key ^ (key >> np.uint64(29))).view(np.int64), own


def explored(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Rows of the shared grams of each text: suffixes of few mates (gram, near, far), passages around common ones (key)."""
    wide = pa.binary(4 * REACH)
    names = ["gram", "near", "far", "key", "t", "pos"]

    def suffix_batch(gram: np.ndarray, right: np.ndarray, left: np.ndarray, t: int, pos: np.ndarray) -> pa.RecordBatch:
        near, far = (
            pa.FixedSizeBinaryArray.from_buffers(wide, len(pos), [None, pa.py_buffer(side.tobytes())]).cast(pa.binary())
            for side in (right, left)
        )
        return pa.record_batch([gram, near, far, pa.nulls(len(pos), pa.int64()), np.full(len(pos), t), pos], names=names)

    def passage_batch(key: np.ndarray, t: int, start: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(key), kind) for kind in (pa.int64(), pa.binary(), pa.binary())]
        return pa.record_batch([*none, key, np.full(len(key), t), start], names=names)

    def rows_of(t: int, hashes: np.ndarray, few: np.ndarray, many: np.ndarray) -> Iterator[pa.RecordBatch]:
        grams = grams_of(hashes)
        for first in range(0, len(few), CHUNK):
            own = few[first: first + CHUNK]
            place = unpacked(own)[0]
            yield suffix_batch(grams[place].view(np.int64), *sides(hashes, place), t, own)
        if len(many):
            for key, start in passages_at(hashes, many):
                yield passage_batch(key, t, start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held, size = [], 0
        for batch in batches:
            for t, text, few, many in zip(batch["t"].to_pylist(), raw_texts(batch["text"]), batch["few"], batch["many"], strict=True):
                at = (np.sort(x.values.to_numpy().astype(np.int64)) for x in (few, many))
                for found in rows_of(t, word_hashes(text, known), *at):
                    held.append(found)
                    size += len(found)
                    if size >= 10_000:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    schema = "gram long, near binary, far binary, key long, t long, pos long"
    return texts.join(places, "t").select("t", "text", "few", "many").mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    fixed = column.cast(pa.binary(4 * REACH))
    if not len(fixed):
        return np.empty((0, REACH), ">u4")
    return np.frombuffer(fixed.buffers()[1], ">u4", len(fixed) * REACH, fixed.offset * 4 * REACH).reshape(-1, REACH)


def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal leading words of rows a and b; zeros (outside the text) equal nothing."""
    same = (words[a] == words[b]) & (words[a] != 0)
    return np.where(same.all(axis=1), REACH, same.argmin(axis=1))


def compared(gram: np.ndarray, near: np.ndarray, far: np.ndarray, t: np.ndarray, pos: np.ndarray, inside: bool) -> dict:
    """Matches of rows in sorted order, by the least and the greatest place that holds each passage of 50 words.

    Passage k of a row begins k words before its gram; two rows share it if at least k words to their left and 50 - k
    from the gram on are common. Matches are runs of passages with one partner, among those that the minimiser stands for.
    """
    place, fewest, most = unpacked(pos)
    m = len(gram)
    rows = np.arange(m)
    change = np.flatnonzero(gram[1:] != gram[:-1]) + 1
    stops = np.append(change, m)[np.searchsorted(change, rows, side="right")]
    if inside:
        order = np.lexsort((place, t))
        rank = np.empty(m, np.int32)
        rank[order] = rows
        text_of = t[order]
    else:
        text_of, rank = np.unique(t, return_inverse=True)
        rank = rank.astype(np.int32)
    shift = np.arange(REACH + 1)
    low = np.repeat(rank[:, None], REACH + 1, axis=1)
    high = low.copy()
    for step in range(1, int((stops - rows).max())):
        own = rows[rows + step < stops]
        own = own[rank[own] != rank[own + step]]
        right, left = _common(near, own, own + step) + GRAM, _common(far, own, own + step)
        good = right + left >= LEAST
        own, right, left = own[good], right[good], left[good]
        shared = (shift >= LEAST - right[:, None]) & (shift <= left[:, None])
        for a, b in ((own, own + step), (own + step, own)):
            other = np.where(shared, rank[b][:, None], rank[a][:, None])  # one's own place changes nothing
            low[a], high[a] = np.minimum(low[a], other), np.maximum(high[a], other)
    partner = np.where(low == rank[:, None], high, low)
    partner[(low == high) | (shift < fewest[:, None]) | (shift > most[:, None])] = -1
    opens = np.ones_like(partner, bool)
    opens[:, 1:] = partner[:, 1:] != partner[:, :-1]
    at = np.flatnonzero(opens)
    size = np.diff(np.append(at, opens.size))
    found = partner.ravel()[at]
    at, size, found = at[found >= 0], size[found >= 0], found[found >= 0]
    own, first = at // (REACH + 1), at % (REACH + 1)
    return {
        "t": t[own], "start": place[own] - first - size + 1, "stop": place[own] - first + LEAST, "other": text_of[found],
        "keeps": found > rank[own],
    }


def neighbours(ordered: DataFrame, inside: bool) -> DataFrame:
    """(t, start, stop, other, keeps): matches inside each sorted partition; no gram is in two of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def work(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            gram = table["gram"].to_numpy()
            cut = len(table) if last else int(np.searchsorted(gram, gram[-1]))
            ready, held = table.slice(0, cut), [table.slice(cut)] if cut < len(table) else []
            size = len(table) - cut
            if cut:
                yield pa.record_batch(compared(
                    gram[:cut], _matrix(ready["near"]), _matrix(ready["far"]), ready["t"].to_numpy(), ready["pos"].to_numpy(), inside,
                ))

        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
                if size >= CHUNK:
                    yield from work(False)
        if held:
            yield from work(True)

    return ordered.mapInArrow(run, MATCH)


def matches(texts: DataFrame, inside: bool = True) -> DataFrame:
    """(t, start, stop, other, keeps): words of a text that stand elsewhere too."""
    found = staged(anchors(texts), "anchors")
    least, greatest = (F.min("t"), F.max("t")) if not inside else (F.min(F.struct("t", "pos")), F.max(F.struct("t", "pos")))
    shared = staged(
        found.groupBy("gram").agg(least.alias("a"), greatest.alias("b"), F.count("*").alias("n")).where("a < b").select("gram", "n"),
        "shared-grams",
    )
    few = F.col("n") <= MATES + 1
    places = found.join(shared, "gram").groupBy("t").agg(
        F.collect_list(F.when(few, F.col("pos"))).alias("few"), F.collect_list(F.when(~few, F.col("pos"))).alias("many")
    )
    if (shared.agg(F.sum("n")).first()[0] or 0) <= LIGHT:
        places = F.broadcast(places)
    rows = staged(explored(texts, places), "explored", "zstd")
    order = ["gram", "near", "far", "t", "pos"]
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    suffixes = rows.where("gram IS NOT NULL").select(*order)
    compared_rows = staged(neighbours(suffixes.repartitionByRange(parts, "gram").sortWithinPartitions(*order), inside), "neighbours")
    passages = rows.where("key IS NOT NULL").select("key", "t", F.col("pos").alias("start"))
    place = F.struct("t", "start") if inside else F.struct("t")
    common = staged(
        passages.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b"), "common-passages"
    )
    keeps = place == F.col("a")
    rest = passages.join(common, "key").select(
        "t", "start", (F.col("start") + LEAST).alias("stop"), F.when(keeps, F.col("b.t")).otherwise(F.col("a.t")).alias("other"),
        keeps.alias("keeps"),
    )
    return compared_rows.unionAll(rest)


def spans(found: DataFrame) -> DataFrame:
    """(t, start, stop, other, keeps): overlapping and touching matches of a text and a partner as one."""
    key = ["t", "other", "keeps"]
    window = Window.partitionBy(*key).orderBy("start", "stop")
    before = F.max("stop").over(window.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.coalesce(before, F.lit(-1)) < F.col("start")).cast("int")).over(window.rowsBetween(Window.unboundedPreceding, 0))
    marked = found.withColumn("before", before).select("start", "stop", *key, island.alias("island"))
    return marked.groupBy(*key, "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def repeated_passages(docs: DataFrame, inside: bool = True) -> DataFrame:
    """One row per document, repeated span and partner: doc_id, start_word, end_word, words, other_doc_id, copy, keeps.

    Copy rows tell that the whole text repeats; the passages it shares with different texts have rows of their own.
    """
    texts = distinct_texts(docs)
    found = staged(spans(matches(representatives(docs, texts), inside)), "spans")
    whole = texts.where((F.col("times") > 1) & (F.col("words") >= LEAST))
    partial = found.join(
        texts.select(F.col("t").alias("other"), F.col("first").alias("other_id")), "other"
    ).select("t", "start", "stop", "other_id", F.lit(None).cast("long").alias("last_id"), F.lit(False).alias("copy"), "keeps")
    copies = whole.select(
        "t", F.lit(0).cast("long").alias("start"), F.col("words").cast("long").alias("stop"),
        F.col("first").alias("other_id"), F.col("last").alias("last_id"), F.lit(True).alias("copy"), F.lit(False).alias("keeps"),
    )
    every = staged(partial.unionAll(copies), "all-spans")
    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    joined = own.join(every, "t")
    first = F.coalesce("doc_id", F.lit(LAST)) == F.col("other_id")
    other = F.when(F.col("copy") & first, F.col("last_id")).otherwise(F.col("other_id"))
    return joined.select(
        "doc_id", F.col("start").alias("start_word"), F.col("stop").alias("end_word"), (F.col("stop") - F.col("start")).alias("words"),
        F.nullif(other, F.lit(LAST)).alias("other_doc_id"), "copy", F.when(F.col("copy"), first).otherwise(F.col("keeps")).alias("keeps"),
    )
