"""Mixing sources to target weights: hierarchical budgets over domain, language and source.

Target weights hold for the children of each node of the tree. A budget of tokens enters at the root and goes down level by
level; a child that can't use its share (its tokens times the greatest number of epochs) gets what it can use, and
the shortage goes to its siblings in proportion to their weights. As a parent's budget never exceeds what its subtree can
use, a shortage leaves a subtree only when no sibling inside can take it.

Each leaf reads its documents in a seeded order of its own for each epoch: whole epochs first, then the prefix of the next
one that fills the budget to the token; the last document of the prefix is taken in part.

The prefix is found without sorting a leaf: orders are MD5 digests, tokens are summed per leaf and leading 12 bits of the
digest, and only the one bucket that the budget ends in is ordered. DataFrame functions only.

Defined results: null text has 0 tokens and is never taken; null languages and sources are leaves of their own; a source
without a number has the domain "other"; nodes without a listed weight have the weight ``UNLISTED``, a weight of 0
gets nothing; budgets above what all leaves can use are cut to that; ties in the order go by doc_id, then tokens; equal
rows share their bucket and are taken one after the other; an empty table gives no rows; other columns pass through
``mixed`` and are not read by ``selection``.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import small_side, staged

SEED = "mix-1"
EPOCHS = 2
#: Share of the corpus' tokens that the mixture has.
SHARE = 0.6
UNLISTED = 0.05
DOMAINS = {"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1}
LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
LEAF = ["domain", "lang_key", "source_key"]


def token_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """d0 to d3 by the number at the end of the source's name."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(number.isNull() | (number == ""), F.lit("other")).otherwise(
        F.concat(F.lit("d"), (number.cast("long") % 4).cast("string"))
    )


def weight_of(name: Column, weights: dict[str, float]) -> Column:
    result = F.lit(UNLISTED)
    for key, weight in weights.items():
        result = F.when(name == key, F.lit(float(weight))).otherwise(result)
    return result


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, leaf keys (nulls as empty text), tokens and ``more``."""
    return docs.select(
        *more, "doc_id", domain_of(F.coalesce("source", F.lit(""))).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang_key"), F.coalesce("source", F.lit("")).alias("source_key"),
        token_count(F.col("text")).alias("tokens"),
    )


def _poured(nodes: DataFrame, parent: list[str], own: str) -> DataFrame:
    """Adds ``share``: the parent's ``budget`` over its children by ``weight``, none above its ``usable``.

    With children in the order usable / weight, a child is full if its level is at most that of the water; the
    water's level is the largest of (budget - usable of earlier ones) / (weights from here on).
    """
    active = nodes.where("weight > 0 AND usable > 0")
    order = Window.partitionBy(*parent).orderBy(F.col("usable") / F.col("weight"), own)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("usable").over(earlier), F.lit(0))) / F.sum("weight").over(onward)
    water = active.withColumn("level", level).withColumn("water", F.max("level").over(Window.partitionBy(*parent)))
    return water.withColumn(
        "share", F.least(F.col("usable").cast("double"), F.col("weight") * F.col("water"))
    ).drop("level", "water", "budget", "weight")


def budgets(leaves: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(leaf keys, tokens, budget long) from (leaf keys, tokens): one row per leaf, few rows in all."""
    usable = F.sum(F.col("tokens") * epochs).alias("usable")
    domains = leaves.groupBy("domain").agg(usable, F.sum("tokens").alias("own")).withColumns(
        {"root": F.lit(1), "weight": weight_of(F.col("domain"), DOMAINS)}
    )
    whole = F.sum("own").over(Window.partitionBy("root")) * F.lit(share)
    top = _poured(domains.withColumn("budget", whole), ["root"], "domain")
    languages = leaves.groupBy("domain", "lang_key").agg(usable).withColumn(
        "weight", weight_of(F.col("lang_key"), LANGUAGES)
    ).join(top.select("domain", F.col("share").alias("budget")), "domain")
    middle = _poured(languages, ["domain"], "lang_key")
    sources = leaves.select(
        *LEAF, "tokens", (F.col("tokens") * epochs).alias("usable"), F.lit(1.0).alias("weight")
    ).join(middle.select("domain", "lang_key", F.col("share").alias("budget")), ["domain", "lang_key"])
    bottom = _poured(sources, ["domain", "lang_key"], "source_key")
    return bottom.select(*LEAF, "tokens", F.floor(F.round("share", 6)).cast("long").alias("budget"))


def digest(epoch: Column, seed: str) -> Column:
    """Place of a document in an epoch's order, as hex digits."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def chosen(rows: DataFrame, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """Rows (doc_id, leaf keys, tokens, more) with whole (epochs read in full) and part (tokens of the next one)."""
    leaves = rows.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"))
    targets = staged(budgets(leaves, share, epochs), "budgets").select(
        *LEAF, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")
    )
    ordered = (
        rows.where("tokens > 0").join(targets, LEAF)
        .withColumn("place", digest(F.col("whole"), seed)).withColumn("bucket", F.substring("place", 1, 3))
    )
    sums = ordered.groupBy(*LEAF, "rest", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    before = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = staged(
        sums.withColumn("start", F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0))).withColumn(
            "room", F.greatest(F.lit(0), F.least("bucket_tokens", F.col("rest") - F.col("start")))
        ).select(*LEAF, "bucket", "room", "bucket_tokens"),
        "filled-buckets",
    )
    placed = ordered.join(filled, [*LEAF, "bucket"])
    uniform = placed.where("room = 0 OR room = bucket_tokens").withColumn(
        "part", F.when(F.col("room") == 0, F.lit(0)).otherwise(F.col("tokens"))
    )
    earlier = Window.partitionBy(*LEAF).orderBy("place", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    last = placed.where("room > 0 AND room < bucket_tokens").withColumn(
        "part", F.greatest(F.lit(0), F.least(F.col("tokens"), F.col("room") - F.coalesce(F.sum("tokens").over(earlier), F.lit(0))))
    )
    return uniform.unionByName(last).drop("place", "bucket", "room", "bucket_tokens", "rest").where("whole > 0 OR part > 0")


def selection(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document and epoch that reads it: doc_id, leaf, tokens, epoch (from 0), taken tokens."""
    found = chosen(staged(keyed(docs), "keyed"), share, epochs, seed)
    reads = F.expr(
        "CASE WHEN part > 0 THEN sequence(0, CAST(whole AS INT)) ELSE sequence(0, CAST(whole AS INT) - 1) END"
    )
    return found.withColumn("epoch", F.explode(reads)).select(
        "doc_id", "domain", F.col("lang_key").alias("lang"), F.col("source_key").alias("source"), "tokens", "epoch",
        F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.col("part")).alias("taken"),
    )


def mixed(docs: DataFrame, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """The documents of a mixture of one epoch, with all their columns, once for each row of the input.

    As no document is given twice, a leaf can use its tokens once; its shortage goes to siblings that still have documents.
    The choice is made on ids and counts; texts are only joined to it. Rows of one doc_id and text share their fate.
    """
    chosen_rows = chosen(staged(keyed(docs, F.xxhash64("text").alias("__text")), "keyed"), share, 1, seed)
    ids = small_side(staged(chosen_rows.select(F.col("doc_id").alias("__id"), "__text").distinct(), "chosen-ids"))
    return docs.join(
        ids, docs["doc_id"].eqNullSafe(ids["__id"]) & (F.xxhash64(docs["text"]) == ids["__text"]), "left_semi"
    )


#: The same selection as SQL; a tree of three levels, each poured by windows.
ORACLE_SQL = rf"""
WITH keyed AS (
  SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
      ELSE 'd' || (CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % 4) END AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM keyed GROUP BY ALL),
d0 AS (SELECT domain, CAST(sum(tokens * {EPOCHS}) AS BIGINT) AS usable,
    CASE domain {' '.join(f"WHEN '{k}' THEN {w}" for k, w in DOMAINS.items())} ELSE {UNLISTED} END::DOUBLE AS weight,
    (SELECT sum(tokens) FROM leaves)::DOUBLE * {SHARE}::DOUBLE AS budget FROM leaves GROUP BY domain HAVING sum(tokens) > 0),
d1 AS (SELECT *, (budget - coalesce(sum(usable) OVER (ORDER BY usable / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY usable / weight, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM d0),
d2 AS (SELECT domain, least(usable::DOUBLE, weight * max(level) OVER ()) AS share FROM d1),
l0 AS (SELECT domain, lang, CAST(sum(tokens * {EPOCHS}) AS BIGINT) AS usable,
    CASE lang {' '.join(f"WHEN '{k}' THEN {w}" for k, w in LANGUAGES.items())} ELSE {UNLISTED} END::DOUBLE AS weight,
    any_value(share) AS budget FROM leaves JOIN d2 USING (domain) GROUP BY domain, lang HAVING sum(tokens) > 0),
l1 AS (SELECT *, (budget - coalesce(sum(usable) OVER (PARTITION BY domain ORDER BY usable / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (PARTITION BY domain ORDER BY usable / weight, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM l0),
l2 AS (SELECT domain, lang, least(usable::DOUBLE, weight * max(level) OVER (PARTITION BY domain)) AS share FROM l1),
s0 AS (SELECT domain, lang, source, tokens, tokens * {EPOCHS} AS usable, 1.0::DOUBLE AS weight, share AS budget
    FROM leaves JOIN l2 USING (domain, lang) WHERE tokens > 0),
s1 AS (SELECT *, (budget - coalesce(sum(usable) OVER (PARTITION BY domain, lang ORDER BY usable / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (PARTITION BY domain, lang ORDER BY usable / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s0),
targets AS (SELECT domain, lang, source,
    CAST(floor(round(least(usable::DOUBLE, weight * max(level) OVER (PARTITION BY domain, lang)), 6)) AS BIGINT) AS budget, tokens AS leaf_tokens FROM s1),
placed AS (SELECT k.*, budget // leaf_tokens AS whole, budget % leaf_tokens AS rest,
    md5(concat_ws('|', '{SEED}', CAST(budget // leaf_tokens AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) AS place
  FROM keyed k JOIN targets USING (domain, lang, source) WHERE k.tokens > 0),
parts AS (SELECT *, greatest(0, least(tokens, rest - coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY place, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS part FROM placed),
reads AS (SELECT *, unnest(range(0, (whole + CASE WHEN part > 0 THEN 1 ELSE 0 END)::BIGINT)) AS epoch FROM parts)
SELECT doc_id, domain, lang, source, tokens, CAST(epoch AS INTEGER) AS epoch, CASE WHEN epoch < whole THEN tokens ELSE part END AS taken FROM reads
"""
