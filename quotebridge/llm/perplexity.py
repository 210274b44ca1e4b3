"""Quality rules: word rules and an n-gram perplexity band for each language.

The language model is a modified Kneser-Ney model over UTF-16 units, as nearly every word of a large corpus is rare:
over words, junk would hide in the class of unknown words. A 4-gram packs into 64 bits without collisions.
Spark counts the 4-grams of all texts; lower orders use continuation counts. As all scored texts are counted, each of their
4-grams has its own probability in the stored model, whatever the size of the corpus. The most frequent ones, at most
``ARRAY_ROWS``, are broadcast as sorted arrays per language, which are searched in blocks of texts; the 4-grams of a text that are
not among them are joined to the stored rest of the model and added to its sum. How many are broadcast changes no result.

The log perplexity of a document is its negative log probability per word that is more than punctuation. Its spread falls
with the root of the words, so the band of a language is narrower for longer texts: a document is kept if no base rule
fails and its log perplexity is within ``WIDTH`` deviations of the median of its language, a deviation being the
larger of ``FLOOR`` and s / root of its words, s from the median absolute deviation of all documents of the language.

Defined results: null text has no words; a null language is a language of its own; texts of under 4 units have no
perplexity and are judged by the base rules alone, texts of punctuation count as one word; repeated rows give repeated rows; an empty table gives no rows; only
doc_id, lang and text are read.
"""

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebridge.llm.common import raw_texts, small_side, staged, tidy

ORDER = 4
ARRAY_ROWS = 1_000_000
WIDTH, FLOOR = 5.0, 0.1
#: Decimals of the grid on which the medians of the bands are taken.
GRID = 3
MIN_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = string.punctuation.encode()
#: Units that one call of numpy works on; bounds the memory of a task.
UNITS = 2_000_000
#: 4-grams that one row of a text's rest holds.
REST = 4096
METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lexical long, n_units long, loss double"
)

Arrays = dict[tuple[str, str, int], tuple[np.ndarray, np.ndarray]]


# --- base rules ------------------------------------------------------------------------------

def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of 5 words that occur twice or more in the text."""
    count = len(words) - WINDOW + 1
    if count < 2:
        return 0
    ids: dict[bytes, int] = {}
    one = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    two = np.unique(one[:-1] * len(ids) + one[1:], return_inverse=True)[1]
    pairs = int(two.max()) + 1
    four = np.unique(two[:-2] * pairs + two[2:], return_inverse=True)[1]
    five = four[:count] * len(ids) + one[WINDOW - 1:]
    _, at, seen = np.unique(five, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(seen[at] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def base_metrics(text: bytes) -> tuple[int, int, int, int, int, bool, int]:
    words = text.split()
    solid = np.frombuffer(b"".join(words), np.uint8)
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    return (
        len(words),
        int(((solid & 0xC0) != 0x80).sum()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(words) < MIN_WORDS or 100 * repeated > REPEATED_PERCENT * len(words),
        max(1, len(text.translate(None, PUNCTUATION).split())),
    )


# --- model -----------------------------------------------------------------------------------

def units(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-16-le"), np.uint16)


def grams(symbols: np.ndarray) -> np.ndarray:
    """Packed 4-grams of a sequence of at least 4 units, the first unit in the highest bits."""
    wide = symbols.astype(np.uint64)
    return wide[:-3] << np.uint64(48) | wide[1:-2] << np.uint64(32) | wide[2:-1] << np.uint64(16) | wide[3:]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(keys), pa.string()), "gram": keys.view(np.int64), "n": n.astype(np.int64)
                })
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), raw_texts(batch["text"]), strict=True):
                symbols = units(text)
                for at in range(0, max(0, len(symbols) - ORDER + 1), UNITS):
                    part = grams(symbols[at: at + UNITS + ORDER - 1])
                    held.setdefault(lang, []).append(part)
                    size += len(part)
                    if size >= UNITS:
                        yield from flush()
                        size = 0
        yield from flush()

    found = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text").mapInArrow(tidy(run), "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts d1, d2, d3 of a level, per language."""
    seen = level.groupBy("lang").agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))  # null where every gram occurs three times or more

    def discount(i: int):
        value = F.lit(i) - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), F.coalesce(value, F.lit(0.5 * i)))).alias(f"d{i}")

    return seen.select("lang", *[discount(i) for i in (1, 2, 3)])


def kneser_ney(counts: DataFrame) -> list[tuple[int, DataFrame, DataFrame]]:
    """For orders 1 to 4: (order, grams: lang, gram, n, p; contexts: lang, gram, n, weight), all stored."""
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
        levels[order] = staged(
            levels[order + 1].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n")), f"level{order}"
        )
    found: list[tuple[int, DataFrame, DataFrame]] = []
    lower = None
    for order in range(1, ORDER + 1):
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        discounts = small_side(staged(_discounts(levels[order]), "discounts"))
        reduced = levels[order].join(discounts, "lang").select(
            "lang", "gram", "n", cut.alias("cut"), F.shiftrightunsigned("gram", 16).alias("context")
        )
        contexts = staged(
            reduced.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")),
            f"contexts{order}",
        )
        joined = reduced.join(contexts, ["lang", "context"])
        if lower is None:
            joined = joined.withColumn("below", F.lit(2.0 ** -16))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
            joined = joined.withColumn("suffix", suffix).join(
                lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"]
            )
        lower = staged(
            joined.select("lang", "gram", "n", ((F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("below")).alias("p")),
            f"grams{order}",
        )
        found.append((order, lower, contexts.select("lang", F.col("context").alias("gram"), F.col("total").alias("n"), "weight")))
    return found


def _frequent(level: DataFrame, rows: int) -> Column:
    """Whether an entry of a level is among its most frequent ones, which are at most ``rows``; all are if they fit."""
    step = F.floor(F.log2("n") * 16)
    steps = level.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in steps:  # one row for each sixteenth of a power of two: about a thousand at most
        total += row["rows"]
        if total > rows:
            break
        least = row["step"]
    return step >= least if least is not None else F.lit(False)


def _arrays(level: DataFrame, kind: str, order: int, value: str) -> Arrays:
    """Sorted keys and natural logs of ``value`` of a level, per language."""
    arrays: Arrays = {}
    kept = level.select("lang", "gram", F.log(value).cast("float").alias("value")).toArrow()
    lang = np.asarray(kept["lang"].to_numpy(), dtype=object)
    gram = kept["gram"].to_numpy().astype(np.int64).view(np.uint64)
    values = kept["value"].to_numpy().astype(np.float32)
    for name in sorted(set(lang.tolist())):
        own = np.flatnonzero(lang == name)
        own = own[np.argsort(gram[own])]
        arrays[name, kind, order] = (gram[own], values[own])
    return arrays


def sorted_arrays(counts: DataFrame, rows: int = ARRAY_ROWS) -> Arrays:
    """The most frequent entries of all orders, probabilities ("p") and back-off weights ("w"): a small model for any text."""
    arrays: Arrays = {}
    for order, probabilities, contexts in kneser_ney(counts):
        for kind, level, value in (("p", probabilities, "p"), ("w", contexts, "weight")):
            arrays |= _arrays(level.where(_frequent(level, rows)), kind, order, value)
    return arrays


def split_model(counts: DataFrame, rows: int = ARRAY_ROWS) -> tuple[Arrays, DataFrame]:
    """The whole model of the counted 4-grams: the most frequent as sorted arrays, the others as (lang, gram, value)."""
    level = kneser_ney(counts)[-1][1]
    frequent = _frequent(level, rows)
    rest = level.where(~frequent).select("lang", "gram", F.log("p").cast("float").alias("value"))
    return _arrays(level.where(frequent), "p", ORDER, "p"), rest


def _search(arrays: Arrays, key: tuple[str, str, int], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found or not, value or 0) of each wanted key."""
    keys, values = arrays.get(key, (np.empty(0, np.uint64), np.empty(0, np.float32)))
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return hit, np.where(hit, values[at], np.float32(0)).astype(np.float64)


def log_probabilities(arrays: Arrays, lang: str, packed: np.ndarray) -> np.ndarray:
    """Natural log probability of the last unit of each 4-gram given the three before it."""
    result = np.zeros(len(packed))
    rest = np.arange(len(packed))
    for order in range(ORDER, 0, -1):
        own = packed[rest] & np.uint64((1 << 16 * order) - 1)
        hit, value = _search(arrays, (lang, "p", order), own)
        result[rest[hit]] += value[hit]
        rest, own = rest[~hit], own[~hit]
        result[rest] += _search(arrays, (lang, "w", order), own >> np.uint64(16))[1]
    result[rest] += np.log(2.0 ** -16)
    return result


def losses(arrays: Arrays, langs: list[str], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(predicted units, negative log probability of the 4-grams in the arrays) of each text, and the other 4-grams: text, gram.

    Texts of a language go together.
    """
    count, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    others, missing = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for lang in set(langs):
        parts: list[np.ndarray] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            if parts:
                packed = np.concatenate(parts)
                hit, found = _search(arrays, (lang, "p", ORDER), packed)
                lengths = [len(p) for p in parts]
                np.add.at(total, owners, np.add.reduceat(found, np.cumsum([0] + lengths[:-1])))
                missing.append(packed[~hit])
                others.append(np.repeat(np.array(owners, np.int64), lengths)[~hit])
                parts.clear()
                owners.clear()

        for i in (i for i, own in enumerate(langs) if own == lang):
            symbols = units(texts[i])
            for at in range(0, max(0, len(symbols) - ORDER + 1), UNITS):
                parts.append(grams(symbols[at: at + UNITS + ORDER - 1]))
                owners.append(i)
                count[i] += len(parts[-1])
                size += len(parts[-1])
                if size >= UNITS:
                    flush()
                    size = 0
        flush()
    return count, -total, np.concatenate(others), np.concatenate(missing)


def scanned(docs: DataFrame, arrays: Arrays, carry: list[str]) -> DataFrame:
    """(row: the columns named in ``carry``, lang, base metrics, n_units, loss, key, rest null) of each document, and
    (row null, lang, metrics null, key, rest: up to ``REST`` 4-grams) for its 4-grams that the arrays don't hold.

    The loss is the sum over the 4-grams in the arrays. The key is a new one for each document, so the result must be stored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(arrays)
    chosen = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce("lang", F.lit("")).alias("lang"), "text"
    )
    fields = [T.StructField("row", chosen.schema["row"].dataType), T.StructField("lang", T.StringType())]
    schema = T.StructType(fields + T._parse_datatype_string(METRICS + ", key long, rest array<long>").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                texts, langs = list(raw_texts(batch["text"])), batch["lang"].to_pylist()
                metrics_of = list(map(base_metrics, texts))
                metrics = list(zip(*metrics_of, strict=True))
                count, loss, others, missing = losses(shared.value, langs, texts)
                columns = [pa.array(m, pa.bool_() if k == 5 else pa.int64()) for k, m in enumerate(metrics)]
                columns += [pa.array(count), pa.array(loss), pa.array(np.arange(key, key + len(batch)))]
                rests = pa.nulls(len(batch), pa.list_(pa.int64()))
                yield pa.record_batch([batch["row"], batch["lang"], *columns, rests], names=schema.names)
                if len(missing):
                    order = np.argsort(others, kind="stable")
                    others, missing = others[order], missing[order]
                    first = np.searchsorted(others, others)  # place of the first 4-gram of the same text
                    starts = np.flatnonzero((np.arange(len(others)) - first) % REST == 0)
                    for some in range(0, len(starts), 512):
                        own = starts[some: some + 512]
                        stop = starts[some + 512] if some + 512 < len(starts) else len(others)
                        texts_of = pa.array(others[own])
                        filled = {
                            "row": pa.nulls(len(own), batch["row"].type),
                            "lang": batch["lang"].take(texts_of), "key": pa.array(key + others[own]),
                            "rest": pa.ListArray.from_arrays(
                                pa.array(np.append(own, stop) - own[0], pa.int32()), pa.array(missing[own[0]: stop].view(np.int64))
                            ),
                        }
                        nulls = {name: pa.nulls(len(own), c.type) for name, c in zip(schema.names[2:], columns)}
                        yield pa.record_batch({name: (nulls | filled)[name] for name in schema.names})
                key += len(batch)

    return chosen.mapInArrow(tidy(run), schema)


def rated(docs: DataFrame, arrays: Arrays, rest: DataFrame, carry: list[str]) -> DataFrame:
    """(row, lang, base metrics, n_units, loss per word) of each document, over all its 4-grams."""
    found = staged(scanned(docs, arrays, carry), "scanned")
    others = found.where("rest IS NOT NULL").select("key", "lang", F.explode("rest").alias("gram"))
    sums = others.join(rest, ["lang", "gram"]).groupBy("key").agg((-F.sum("value")).alias("other"))
    joined = found.where("rest IS NULL").drop("rest").join(small_side(staged(sums, "rest-sums")), "key", "left")
    loss = F.when(F.col("n_units") > 0, (F.col("loss") + F.coalesce("other", F.lit(0.0))) / F.col("n_lexical"))
    return joined.withColumn("loss", loss).drop("key", "other")


def medians(values: DataFrame, value: Column, name: str) -> DataFrame:
    """(lang, name): the exact median, per language, of values on a fixed grid; the same in every run.

    Values are counted per grid point first, so what one task orders are the grid points in use.
    """
    counted = values.select("lang", F.round(value, GRID).alias("point")).groupBy("lang", "point").agg(F.count("*").alias("n"))
    return counted.groupBy("lang").agg(F.percentile("point", 0.5, F.col("n")).alias(name))


def judged(scores: DataFrame) -> DataFrame:
    """The ``rated`` rows with kept, lower and upper: inside the band of their language, and no base rule failed."""
    usable = scores.where("NOT base_failed AND loss IS NOT NULL")
    middle = small_side(staged(medians(usable, F.col("loss"), "middle"), "middles"))
    root = F.sqrt("n_lexical")
    apart = usable.join(middle, "lang")
    spread = medians(apart, F.abs(F.col("loss") - F.col("middle")) * root, "apart").select("lang", (1.4826 * F.col("apart")).alias("spread"))
    bands = small_side(staged(middle.join(spread, "lang"), "bands"))
    half = WIDTH * F.greatest(F.lit(FLOOR), F.col("spread") / root)
    banded = scores.join(bands, "lang", "left").withColumn("lower", F.col("middle") - half).withColumn("upper", F.col("middle") + half)
    inside = F.coalesce(F.col("loss").between(F.col("lower"), F.col("upper")), F.lit(True))
    return banded.withColumn("kept", ~F.col("base_failed") & inside)


def quality(docs: DataFrame, carry: list[str], rows: int = ARRAY_ROWS) -> DataFrame:
    """Counts, fits, scores and judges all documents: (row, metrics, band, kept)."""
    counts = staged(gram_counts(docs), "gram-counts")
    return judged(rated(docs, *split_model(counts, rows), carry))


def verdicts(docs: DataFrame, rows: int = ARRAY_ROWS) -> DataFrame:
    """One row per document with its metrics and the verdict ``kept``."""
    return quality(docs, ["doc_id"], rows).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lang", "n_lexical", "loss", "lower", "upper",
    )


def accepted(docs: DataFrame, rows: int = ARRAY_ROWS) -> DataFrame:
    """The kept documents with all their columns."""
    return quality(docs, docs.columns, rows).where("kept").select("row.*")
