"""Line dedup by an exact set-similarity join: lines that resemble an earlier line of the corpus go.

A line is the set of its folded words. Lines are in the order of doc_id and line number (equal ones, of repeated ids, by their hashes). A line goes if an earlier
one, kept or not, has a Jaccard similarity of at least 0.8 with it; the first line of each group stays. Lines without a
word always stay.

Equal sets are one class, with the first line as its representative; only classes are joined. Words are ordered by rarity
(counted over all texts into 2^20 cells of one byte each); any order gives the same result, a good one short lists.
Two similar sets share one of their first n - ceil(0.8 n) + 1 words in that order (prefix filter); the sizes and the place of
that word bound the overlap (length and positional filter), and so do parities of the words in 64 bits, of large sets in 128.
Lists of up to ``LIST`` classes are joined with themselves on the word. Which are longer is told by the classes of a fixed share of
hashes, and decides only the way that a pair is found: the first two shared words of two similar sets are among their first
n - ceil(0.8 n) + 2, so where the first of them has a long list, all pairs of words that begin with it are lists of their own. Pairs with
more than ``PAIRS`` classes are mostly copies of one line with few changes: there each class meets the ``NEAR`` classes before it; those
that find no match go round again among themselves, and what then is left is joined with all of those lists. So no long
list of copies is paired out, and no match is lost. Of the possible partners of a class the most alike is verified first, the others
only if that one fails.

DataFrame functions only. In candidates, words are 56-bit hashes below 7 bits of rarity; the final check compares them as they
are. A class is known by 64 bits of the hash of its words. Intermediate tables are deleted as soon as they have been used, and
Spark deletes the shuffle files of each of them once it is stored.

Defined results: null text is one line without words; null doc_ids come last in the order; repeated rows share their fate; an
empty table gives no rows; similarity is exact at 0.8; only doc_id and text are read.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import BROADCAST_ROWS, small_side, staged
from quotebridge.sinks.staging import shuffles_freed, stages

CELLS = 1 << 20
LIST, PAIRS, NEAR = 512, 64, 32
#: Size of a set from which its parity has 128 bits.
WIDE = 60
#: Largest table of places that is broadcast.
FEW = 100_000
LAST = (1 << 63) - 1
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\v\f\r"
FOLDED = "abcdefghijklmnopqrstuvwxyz    "
#: A line with other letters than ASCII or with blanks other than spaces.
ODD = r"[^\x00-\x08\x0E-\x7F]"
PLACE = ["d", "l", "t"]
#: What the filters look at: size, parities and, where a set stands in a list, the place of the word in it.
SET = ["h", "n", "sig", "sig2"]
ENTRY = [*SET, "pos"]
#: Stores a table and reads it back; it goes when the part of the job ends that asked for it.
Stage = Callable[[DataFrame, str], DataFrame]
#: Order of the classes: by their first line, which two classes share only if a doc_id is repeated.
ORDER = ["d", "l", "h"]


def rows_of(docs: DataFrame) -> DataFrame:
    """(d, t, text): place of a document in the order of the corpus."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(text).alias("t"), text.alias("text")
    )


def words_of(line: Column) -> Column:
    """Words of a line, folded, with an empty one for each blank too many."""
    odd = F.regexp_like(line, F.lit(ODD))
    return F.split(F.when(odd, F.translate(line, LETTERS, FOLDED)).otherwise(F.lower(line)), " ")


def cell(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(CELLS - 1)).cast("int")


def rarity(rows: DataFrame) -> Column:
    """One byte per cell, from 1 (rarest) to 127: four steps for each doubling of the words of all texts in the cell.

    The cells are put in order by 1,024 groups, whose strings come to the driver: ``CELLS`` bytes whatever the data.
    """
    counted = lines_of(rows).select(F.explode(words_of(F.col("line"))).alias("w")).groupBy(cell(F.xxhash64("w")).alias("cell")).count()
    level = F.least(F.lit(127), F.floor(F.log2(F.col("count") + 1) * 4)).cast("int")
    every = rows.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell"))
    filled = every.join(counted.select("cell", level.alias("level")), "cell", "left").withColumn("level", F.coalesce("level", F.lit(1)))
    pairs = F.sort_array(F.collect_list(F.struct("cell", F.char("level").alias("byte"))))
    groups = filled.groupBy(F.shiftright("cell", 10).alias("part")).agg(F.array_join(F.transform(pairs, lambda p: p["byte"]), "").alias("bytes"))
    return F.lit("".join(r["bytes"] for r in sorted(groups.collect())).encode())


def with_keys(lines: DataFrame, levels: Column) -> DataFrame:
    """Adds ``keys``: one number for each distinct word of ``line``, its rarity above its hash, in that order."""

    def key(hashed: Column) -> Column:
        level = F.ascii(F.substring(levels, cell(hashed) + 1, 1).cast("string")).cast("long")
        return F.call_function("shiftleft", level, F.lit(56)).bitwiseOR(F.shiftrightunsigned(hashed, 8))

    hashes = F.transform(words_of(F.col("line")), lambda word: F.xxhash64(word))
    distinct = F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit("")))
    return lines.withColumn("keys", F.sort_array(F.transform(distinct, key))).drop("line")


def lines_of(rows: DataFrame) -> DataFrame:
    return rows.select("d", "t", F.posexplode(F.split("text", "\n")).alias("l", "line"))


def parity(keys: Column, bit: Column | None = None) -> Column:
    """Which of 64 bits are set by an odd number of words; with ``bit``, only by those in whose seventh bit it is."""

    def one(key: Column) -> Column:
        mark = F.lit(1).cast("long") if bit is None else F.shiftright(key, 6).bitwiseAND(bit)
        return F.call_function("shiftleft", mark, key.bitwiseAND(F.lit(63)).cast("int"))

    return F.aggregate(keys, F.lit(0).cast("long"), lambda acc, key: acc.bitwiseXOR(one(key)))


def classes(rows: DataFrame, levels: Column) -> DataFrame:
    """One row per distinct set: h, d, l, t (its first line), n, sig and sig2 (parities of its words), prefix (one word more than
    the prefix filter needs)."""
    first = F.slice("keys", 1, F.expr("size(keys) - (4 * size(keys) + 4) div 5 + 2").cast("int"))
    described = with_keys(lines_of(rows), levels).select(
        *PLACE, F.xxhash64("keys").alias("h"), F.size("keys").alias("n"), parity(F.col("keys")).alias("sig"),
        F.when(F.size("keys") > WIDE, parity(F.col("keys"), F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long")).alias("sig2"),
        first.alias("prefix"),
    )
    found = described.groupBy("h").agg(F.min(F.struct(F.struct(*PLACE).alias("place"), "n", "sig", "sig2", "prefix")).alias("first"))
    return found.select("h", "first.place.*", "first.n", "first.sig", "first.sig2", "first.prefix").where("n > 0")


def apart(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """At most as many as the words that only one of two sets has."""
    one, two = a["sig"].bitwiseXOR(b["sig"]), a["sig2"].bitwiseXOR(b["sig2"])
    wide = (a["n"] > WIDE) & (b["n"] > WIDE)
    return F.when(wide, F.bit_count(one.bitwiseXOR(two)) + F.bit_count(two)).otherwise(F.bit_count(one))


def possible(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """What length, position and parity leave of a pair whose first common word is this one."""
    least = F.ceil(4 * (a["n"] + b["n"]) / 9)
    return (
        (5 * a["n"] >= 4 * b["n"]) & (5 * b["n"] >= 4 * a["n"]) & (a["n"] - a["pos"] >= least) & (b["n"] - b["pos"] >= least)
        & (apart(a, b) <= a["n"] + b["n"] - 2 * least)
    )


def postings(sets: DataFrame, *more: str) -> DataFrame:
    """(key, h, n, sig, sig2, pos and ``more``): sets of up to 3 words only equal their like, so they have none."""
    return sets.where("n > 3").select(*SET, *more, F.posexplode(F.expr("slice(prefix, 1, size(prefix) - 1)")).alias("pos", "key"))


def pair_postings(sets: DataFrame, long_lists: DataFrame, *more: str) -> DataFrame:
    """As ``postings``, of pairs of words of which the first has a long list; pos is one less than that of the second, as one more
    word is known to be shared."""
    crowded = postings(sets, "prefix", *more).join(long_lists, "key", "left_semi")
    after = crowded.select(*ENTRY, *more, "key", F.posexplode(F.expr("slice(prefix, pos + 2, size(prefix))")).alias("step", "second"))
    return after.select(*SET, *more, (F.col("pos") + F.col("step")).alias("pos"), F.xxhash64("key", "second").alias("key"))


def long_keys(entries: DataFrame, size: int) -> DataFrame:
    """(key) of the lists with about more than ``size`` entries, as far as one class of ``size`` / 16 tells."""
    part = max(1, size // 16)
    return entries.where(F.pmod("h", F.lit(part)) == 0).groupBy("key").count().where(F.col("count") * part > size).select("key")


def matches(entries: DataFrame) -> DataFrame:
    """(a, b, apart): the possible pairs of all lists, a pair once for each list."""
    mine = entries.select("key", *ENTRY)
    others = entries.select(F.col("key").alias("key_o"), *[F.col(c).alias(f"{c}_o") for c in ENTRY])
    a, b = ({c: F.col(c + end) for c in ENTRY} for end in ("", "_o"))
    return mine.join(others, (F.col("key") == F.col("key_o")) & (F.col("h") < F.col("h_o")) & possible(a, b)).select(
        F.col("h").alias("a"), F.col("h_o").alias("b"), apart(a, b).alias("apart")
    )


def neighbours(entries: DataFrame, width: int) -> DataFrame:
    """(a, b, apart): each class and its possible partners among the ``width`` before it in its lists."""
    window = Window.partitionBy("key").orderBy(*ORDER)
    mine = {c: F.col(c) for c in ENTRY}
    before = F.collect_list(F.struct(*ENTRY)).over(window.rowsBetween(-width, -1))
    near = F.transform(
        F.filter("before", lambda o: possible(mine, {c: o[c] for c in ENTRY}) & (o["h"] != F.col("h"))),
        lambda o: F.struct(o["h"].alias("b"), apart(mine, {c: o[c] for c in ENTRY}).alias("apart")),
    )
    return entries.withColumn("before", before).select(F.col("h").alias("a"), F.explode(near).alias("one")).select("a", "one.*")


class Verifier:
    """Exact similarity of pairs of classes, from the lines that represent them."""

    def __init__(self, rows: DataFrame, sets: DataFrame, ids: DataFrame, stage: Stage):
        """``ids``: (h) of the classes that will be asked for."""
        wanted = stage(sets.join(small_side(stage(ids, "wanted"), FEW), "h", "left_semi").select("h", *PLACE), "wanted-lines")
        few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        wanted = F.broadcast(wanted) if few else wanted
        documents = rows.join(F.broadcast(wanted.select("d", "t").distinct()) if few else wanted.select("d", "t"), ["d", "t"], "left_semi")
        found = lines_of(documents).join(wanted, PLACE).dropDuplicates(["h"])
        self.lines = stage(found.select(*ORDER, "line"), "lines")
        self.places = small_side(self.lines.select(*ORDER), FEW)

    def directed(self, pairs: DataFrame) -> DataFrame:
        """(x, y, apart) with y before x in the corpus, from unordered (a, b, apart)."""
        own = self.places.select(F.col("h").alias("a"), F.struct(*ORDER).alias("at_a"))
        other = self.places.select(F.col("h").alias("b"), F.struct(*ORDER).alias("at_b"))
        later = F.col("at_a") > F.col("at_b")
        return pairs.groupBy("a", "b").agg(F.min("apart").alias("apart")).join(own, "a").join(other, "b").select(
            F.when(later, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(later, F.col("b")).otherwise(F.col("a")).alias("y"), "apart"
        )

    def similar(self, pairs: DataFrame, stage: Stage) -> DataFrame:
        """The x of the pairs (x, y) that are similar."""
        both = pairs.join(self.lines.select(F.col("h").alias("x"), F.col("line").alias("line_x")), "x").join(
            self.lines.select(F.col("h").alias("y"), F.col("line").alias("line_y")), "y"
        )
        kx, ky = (F.array_remove(F.array_distinct(words_of(F.col(c))), "") for c in ("line_x", "line_y"))
        alike = 9 * F.size(F.array_intersect(kx, ky)) >= 4 * (F.size(kx) + F.size(ky))
        return stage(both.select("x", alike.alias("alike")), "verdicts").where("alike").select("x")

    def settled(self, pairs: DataFrame, stage: Stage) -> DataFrame:
        """(h), stored by ``stage``: the later classes of the similar pairs among (a, b, apart), the most alike partner of each looked at first."""
        with stages(pairs.sparkSession) as stored:
            own = partial(stored, spread=False)
            all_pairs = own(self.directed(pairs), "pairs")
            best = own(all_pairs.groupBy("x").agg(F.min(F.struct("apart", "y")).alias("b")).select("x", "b.y"), "best-pairs")
            found = self.similar(best, own)
            others = own(
                all_pairs.join(found, "x", "left_anti").join(best, ["x", "y"], "left_anti").select("x", "y"), "other-pairs"
            )
            return stage(found.unionAll(self.similar(others, own)).select(F.col("x").alias("h")).distinct(), "settled")


def removed_classes(rows: DataFrame, sets: DataFrame, stage: Stage, size: int = LIST, width: int = NEAR) -> DataFrame:
    """(h) of the classes that resemble a class with an earlier first line."""
    size_of_pairs = min(size, PAIRS)
    long_lists = small_side(stage(long_keys(postings(sets), size), "long-lists"))
    pairs = stage(matches(postings(sets).join(long_lists, "key", "left_anti")), "pairs-of-words")
    twice = pair_postings(sets, long_lists)
    long_pairs = small_side(stage(long_keys(twice, size_of_pairs), "long-pairs"))
    pairs = pairs.unionAll(stage(matches(twice.join(long_pairs, "key", "left_anti")), "pairs-of-pairs"))
    every = stage(pair_postings(sets, long_lists, "d", "l").join(long_pairs, "key", "left_semi"), "crowded")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("h")).unionAll(every.select("h"))
    verifier = Verifier(rows, sets, ends.distinct(), stage)
    gone = verifier.settled(pairs, stage)
    left = stage(every.join(gone, "h", "left_anti"), "open")
    while not left.isEmpty():
        new = verifier.settled(neighbours(left, width), stage)
        gone = gone.unionAll(new)
        left = stage(left.join(new, "h", "left_anti"), "open")
        if 8 * new.count() < left.select("h").distinct().count():
            break
    if left.isEmpty():
        return gone.distinct()
    own = left.select(*[F.col(c).alias(f"{c}_x") for c in every.columns])
    mine, theirs = ({c: F.col(c + end) for c in ENTRY} for end in ("_x", ""))
    earlier = F.struct(*ORDER) < F.struct(*[f"{c}_x" for c in ORDER])
    rest = own.join(every, F.col("key_x") == F.col("key")).where(earlier & possible(mine, theirs)).select(
        F.col("h_x").alias("a"), F.col("h").alias("b"), apart(mine, theirs).alias("apart")
    )
    return gone.unionAll(verifier.settled(rest, stage)).distinct()


def kept_lines(docs: DataFrame, size: int = LIST, width: int = NEAR) -> DataFrame:
    """(d, t, kept: numbers of the lines with words that stay) of the documents that keep any, stored."""
    rows = rows_of(docs)
    with stages(docs.sparkSession) as stored, shuffles_freed(docs.sparkSession):
        stage = partial(stored, spread=False)
        sets = stage(classes(rows, rarity(rows)), "line-classes")
        gone = removed_classes(rows, sets, stage, size, width)
        stay = sets.join(gone, "h", "left_anti").groupBy("d", "t").agg(F.collect_list("l").alias("kept"))
        return staged(stay, "kept-lines")


def deduplicated(docs: DataFrame, size: int = LIST, width: int = NEAR) -> DataFrame:
    """(doc_id, n_lines, n_removed, text: the lines that stay) of every document."""
    kept = small_side(kept_lines(docs, size, width))
    rows = docs.select("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    placed = rows.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("t", F.xxhash64("text"))
    joined = placed.join(kept, ["d", "t"], "left").withColumn("lines", F.split("text", "\n"))
    stays = F.filter(
        "lines", lambda line, i: F.coalesce(F.array_contains("kept", i), F.lit(False)) | ~F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))
    )
    # most documents lose nothing: their lines are not looked at one by one
    whole = F.size(F.coalesce("kept", F.array())) == F.size("lines")
    return joined.withColumn("stay", F.when(whole, F.col("lines")).otherwise(stays)).select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("n_removed"),
        F.array_join("stay", "\n").alias("text"),
    )


def report(docs: DataFrame, size: int = LIST, width: int = NEAR) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_bytes, kept_crc32) of every document."""
    return deduplicated(docs, size, width).select(
        "doc_id", "n_lines", "n_removed", F.octet_length("text").cast("long").alias("kept_bytes"), F.crc32("text").alias("kept_crc32")
    )
