"""Comparison of internal quotes with published quotes."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.functions.prices import binary_match_class, match_class, price_difference
from quotebridge.schema import COMPARISON_COLUMNS

# Equal on both sides under every rule.
COMMON_PARTS = [
    "pub_date", "publication_name", "commodity_type", "product_type", "location_name", "unit",
    "currency", "end_date",
]
_RULE_INPUT = [
    *COMMON_PARTS, "product_name", "period_duration", "price_uk", "price_mid", "src_price_id",
]


def is_internal(data_source: Column) -> Column:
    return F.lower(data_source).contains(V.INTERNAL_SOURCE_MARK)


def split_sides(quotes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Internal and published quotes of a combined quote view."""
    internal = is_internal(F.col("data_source"))
    return quotes.filter(internal), quotes.filter(~internal)


def in_window(quotes: DataFrame, date_from: date | None, date_to: date | None) -> DataFrame:
    """Optional publication-date window; prunes partitions of a date-partitioned table."""
    if date_from is not None:
        quotes = quotes.filter(F.col("pub_date") >= F.lit(date_from))
    if date_to is not None:
        quotes = quotes.filter(F.col("pub_date") <= F.lit(date_to))
    return quotes


def _slot(product: Column, duration: Column) -> Column:
    return F.struct(product.alias("product"), duration.alias("duration"))


def _internal_slots(quotes: DataFrame) -> DataFrame:
    """Each internal quote looks in exactly one slot of its common parts.

    The combined day-ahead/weekend product compares regardless of duration, so its slot
    leaves the duration out.
    """
    product, duration = F.lower("product_name"), F.lower("period_duration")
    combined = product == V.DA_WSI_PRODUCT
    return quotes.withColumn(
        "slot", _slot(product, F.when(combined, F.lit("*")).otherwise(duration))
    )


def _external_slots(quotes: DataFrame) -> DataFrame:
    """A published quote offers itself in every slot a rule could look for it (at most three)."""
    product, duration = F.lower("product_name"), F.lower("period_duration")
    combined = product == V.DA_WSI_PRODUCT
    own = _slot(product, F.when(combined, F.lit("*")).otherwise(duration))
    as_day = F.when((duration == "weekend") & ~combined, _slot(product, F.lit("day")))
    as_part = F.when(
        product.isin(V.DA_WSI_PARTS), _slot(F.lit(V.DA_WSI_PRODUCT), F.lit("*"))
    )
    return quotes.withColumn("slot", F.explode(F.array_compact(F.array(own, as_day, as_part))))


def _rule() -> Column:
    """Which rule accepts the pair; null when none does. First rule wins."""
    same_product = F.col("i.product_name") == F.col("x.product_name")
    i_duration, x_duration = F.lower("i.period_duration"), F.lower("x.period_duration")
    return (
        F.when(F.col("i.price_uk") == F.col("x.price_uk"), "general")
        .when(
            same_product & i_duration.isin("day", "weekend") & (x_duration == "weekend"),
            "weekend",
        )
        .when(
            (F.lower("i.product_name") == V.DA_WSI_PRODUCT)
            & F.lower("x.product_name").isin(V.DA_WSI_PARTS),
            "da_wsi",
        )
    )


def compared_pairs(internal: DataFrame, external: DataFrame) -> DataFrame:
    """All comparable (internal, published) pairs with the rule that made them comparable.

    Both sides must be unique on ``price_uk``, as the quote tables are. One equi-join on the
    common parts plus product and duration slot: a quote only meets quotes it can match, so
    the join is as large as its result and its keys are close to unique. A published quote
    never offers one slot twice, hence no pair can appear twice and nothing is
    de-duplicated afterwards.
    """
    i = _internal_slots(internal.select(*_RULE_INPUT))
    x = _external_slots(external.select(*_RULE_INPUT))
    on = [F.col(f"i.{c}") == F.col(f"x.{c}") for c in COMMON_PARTS]
    on += [F.col(f"i.slot.{c}") == F.col(f"x.slot.{c}") for c in ("product", "duration")]
    return (
        i.alias("i").join(x.alias("x"), [*on, _rule().isNotNull()]).withColumn("rule", _rule())
    )


def reconcile(
    internal: DataFrame,
    external: DataFrame,
    date_from: date | None = None,
    date_to: date | None = None,
    run_ts: Column | None = None,
    with_rule: bool = False,
) -> DataFrame:
    """Compare internal with published quotes; one row per comparable pair.

    ``run_ts`` adds the comparison timestamp; pass one literal for all outputs of a run.
    """
    pairs = compared_pairs(
        in_window(internal, date_from, date_to), in_window(external, date_from, date_to)
    )
    own, other = F.col("i.price_mid"), F.col("x.price_mid")
    difference = F.when(F.col("rule") == "general", price_difference(own, other, 5)).otherwise(
        price_difference(own, other, 6)
    )
    columns = {
        "pub_date": F.col("i.pub_date"),
        "publication_name": F.col("i.publication_name"),
        "commodity_type": F.col("i.commodity_type"),
        "product_type": F.col("i.product_type"),
        "product_name": F.col("i.product_name"),
        "location_name": F.col("i.location_name"),
        "period_duration": F.col("i.period_duration"),
        "price_end_date": F.col("i.end_date"),
        "endur_mid_price": F.round(own.cast("double"), 6),
        "ext_mid_price": other,
        "mid_price_diff": difference,
        "price_match": match_class(own, other),
        "endur_curve": F.col("i.src_price_id"),
        "unit": F.col("i.unit"),
        "currency": F.col("i.currency"),
        "endur_price_uk": F.col("i.price_uk"),
        "ext_price_uk": F.col("x.price_uk"),
    }
    selected = [columns[c].alias(c) for c in COMPARISON_COLUMNS]
    if run_ts is not None:
        selected.append(run_ts.alias("comparison_date"))
    if with_rule:
        selected.append(F.col("rule"))
    return pairs.select(*selected)


def ordered_comparison(comparison: DataFrame) -> DataFrame:
    """Presentation order; the pair key makes it total."""
    return comparison.orderBy(
        "pub_date", "publication_name", "product_type", "product_name", "location_name",
        "price_end_date", "period_duration", "endur_price_uk", "ext_price_uk",
    )


def unreconciled(internal: DataFrame, comparison: DataFrame) -> DataFrame:
    """Internal quotes without any comparable published quote."""
    compared = comparison.select(F.col("endur_price_uk").alias("price_uk"))
    return internal.join(compared, ["price_uk"], "left_anti")


# --- the earlier attribute-wise comparison -------------------------------------------------

_GENERIC_PARTS = [
    "publication_name", "pub_date", "commodity_type", "product_type", "product_name",
    "location_name", "end_date", "unit", "currency",
]


GENERIC_RULES = ("standard", "weekend", "index")


def _generic_rules(rules: tuple[str, ...]) -> Column:
    """The rules under which published quote ``a`` meets quote ``b`` with equal common parts."""
    a_duration, b_duration = F.lower("a.period_duration"), F.lower("b.period_duration")
    accepted = {
        "standard": (a_duration != "weekend") & (F.col("a.period_duration") == F.col("b.period_duration")),
        "weekend": (a_duration == "weekend") & (b_duration == "day"),
        "index": F.lower("a.product_name").contains("index"),
    }
    return F.array_compact(F.array(*[F.when(accepted[rule], F.lit(rule)) for rule in rules]))


def _generic_pairs(quotes: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """One equi-join on the common parts; a pair comes once for each rule it meets."""
    a = quotes.filter(~is_internal(F.col("data_source"))).alias("a")
    b = quotes.alias("b")
    met = _generic_rules(rules)
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in _GENERIC_PARTS]
    on += [F.col("a.data_source") != F.col("b.data_source"), F.size(met) > 0]
    own, published = F.col("b.price_mid"), F.col("a.price_mid")
    return a.join(b, on).select(
        F.explode(met).alias("rule"),
        "a.pub_date", "a.publication_name", "a.commodity_type", "a.product_type",
        "a.product_name", "a.location_name", "a.period_duration", "a.end_date",
        own.alias("endur_price_mid"),
        published.alias("ext_price_mid"),
        price_difference(published, own, V.OLD_MATCH_DECIMALS).alias("price_mid_diff_abs"),
        F.col("b.src_price_id").alias("endur_curve"),
        F.col("a.data_source").alias("ds_ext"),
        F.col("b.data_source").alias("ds_int"),
        F.col("a.price_uk").alias("ext_price_uk"),
        F.col("b.price_uk").alias("endur_price_uk"),
        binary_match_class(published, own).alias("price_comparison"),
    ).drop("rule")


def reconcile_generic(quotes: DataFrame, rule: str) -> DataFrame:
    """Published quotes against the quotes of every other source, by attributes.

    ``standard``: equal duration, weekends left out; ``weekend``: published weekend against
    day quotes; ``index``: index products at any duration.
    """
    if rule not in GENERIC_RULES:
        raise ValueError(f"unknown rule {rule!r}")
    return _generic_pairs(quotes, (rule,))


def reconcile_all_generic(quotes: DataFrame) -> DataFrame:
    """The three earlier comparisons together, sorted by their first eight columns."""
    pairs = _generic_pairs(quotes, GENERIC_RULES)
    return pairs.orderBy(*pairs.columns[:8], "ext_price_uk", "endur_price_uk")
