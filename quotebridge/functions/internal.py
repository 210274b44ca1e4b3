"""Vocabulary of the trading-system feed."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.functions.text import contains_any, first_match, has_word, padded_words

# Durations tried in this order; the first word list that shares a token wins.
_LONG_PERIODS = [
    ("Week", V.WEEK_WORDS),
    ("Month", V.MONTH_WORDS),
    ("Quarter", V.QUARTER_WORDS),
    ("Season", V.SEASON_WORDS),
    ("Gasyear", V.GASYEAR_WORDS),
    ("Year", V.CALYEAR_WORDS),
]
_SHORT_PERIODS = [("Day", V.DAY_WORDS), ("Weekend", V.WEEKEND_WORDS)]


def texts(publication: Column, index_name: Column) -> dict[str, Column]:
    """Prepared forms of the two names, computed once per row.

    The rules below test them dozens of times; they take the prepared columns so that no
    rule lower-cases, splits or pads a name again.
    """
    return {
        "pub_upper": F.upper(publication),
        "pub_words": padded_words(publication),
        "curve_lower": F.lower(index_name),
        "curve_upper": F.upper(index_name),
        "curve_words": padded_words(index_name),
        "hub": hub(index_name),
    }


def is_unquoted_curve(curve_lower: Column) -> Column:
    """Curves that carry no published quote, recognised by a fragment of the name."""
    return contains_any(curve_lower, [f.lower() for f in V.UNQUOTED_CURVE_FRAGMENTS])


def is_legacy(pub_upper: Column) -> Column:
    return pub_upper.contains(V.LEGACY_MARK.upper())


def hub(index_name: Column) -> Column:
    """Third '_' part of the curve name up to the first '.'; null when there is none."""
    third = F.split_part(index_name, F.lit("_"), F.lit(3))
    return F.nullif(F.split_part(third, F.lit("."), F.lit(1)), F.lit(""))


def location(hub_name: Column) -> Column:
    """Hub code of the hub part of a curve name."""
    name = F.upper(hub_name)
    long_name = F.length(hub_name) > 3
    return first_match(
        [
            (name == "ZBH", F.lit("ZEE")),
            (long_name & (name == "GASPOOL"), F.lit("GPL")),
            (long_name & (name == "ZEEHUB"), F.lit("ZEE")),
            (long_name & name.contains("PEG"), F.lit("PEG")),
        ],
        hub_name,
    )


def _period_from(words: Column, periods: list[tuple[str, list[str]]], default: str) -> Column:
    return first_match([(has_word(words, ws), F.lit(p)) for p, ws in periods], F.lit(default))


def period(pub_words: Column, curve_words: Column) -> Column:
    """Delivery duration. General-purpose publications take it from the curve name."""
    from_curve = _period_from(curve_words, _LONG_PERIODS, "Day")
    from_publication = _period_from(pub_words, _LONG_PERIODS + _SHORT_PERIODS, V.UNDETERMINED)
    return F.when(pub_words.contains(V.GENERAL_PUBLICATION), from_curve).otherwise(
        from_publication
    )


def period_of_relative(period_rel: Column) -> Column:
    """Duration of a relative period code, by prefix; unknown codes stay."""
    return first_match(
        [(period_rel.startswith(p), F.lit(d)) for p, d in V.RELATIVE_PERIOD_PREFIXES], period_rel
    )


def _is_exchange(pub_upper: Column) -> Column:
    return contains_any(pub_upper, V.EXCHANGE_PUBLICATION_MARKS)


def _is_assessor(pub_upper: Column, curve_upper: Column) -> Column:
    return pub_upper.contains(V.ASSESSOR_PUBLICATION_MARK) | curve_upper.contains(
        V.ASSESSOR_CURVE_MARK
    )


def publication_name(pub_upper: Column, curve_upper: Column) -> Column:
    return F.when(_is_exchange(pub_upper), V.EXCHANGE_PUBLICATION).when(
        _is_assessor(pub_upper, curve_upper), V.ASSESSOR_PUBLICATION
    )


def product_name(pub_upper: Column, curve_upper: Column) -> Column:
    exchange_product = first_match(
        [(pub_upper.contains(p), F.lit(p)) for p in ("EOD", "EGSI")], F.lit(V.SETTLEMENT)
    )
    index_product = first_match(
        [(curve_upper.contains(mark), F.lit(name)) for mark, name in V.INDEX_PRODUCTS],
        F.lit(V.UNKNOWN_INDEX),
    )
    assessment = F.when(
        curve_upper.contains(V.CONTINENTAL_MARK), V.CONTINENTAL_ASSESSMENTS
    ).otherwise(V.ASSESSMENTS)
    return F.when(_is_exchange(pub_upper), exchange_product).when(
        _is_assessor(pub_upper, curve_upper),
        F.when(curve_upper.contains(V.INDEX_CURVE_MARK), index_product).otherwise(assessment),
    )


def product_type(pub_upper: Column, curve_upper: Column) -> Column:
    return F.when(
        _is_exchange(pub_upper),
        F.when(contains_any(pub_upper, ["EOD", "EGSI"]), V.SPOT).otherwise(V.FUTURES),
    ).when(_is_assessor(pub_upper, curve_upper), V.SPOT)


def currency(raw: Column) -> Column:
    return F.when(raw.contains("GBP"), "GBp").otherwise(raw)


def price_in_quoted_currency(price: Column, normalized_currency: Column) -> Column:
    """Pounds become pence; everything already marked as pence is scaled too."""
    return F.when(normalized_currency == "GBp", price * 100).otherwise(price)


def unit(raw: Column) -> Column:
    return F.when(F.lower(raw).contains("therm"), "therm").otherwise(raw)


def last_day_of_next_month(day: Column) -> Column:
    return F.last_day(F.add_months(day, 1))


def month_ahead_end(product: Column, pub_date: Column, end_date: Column) -> Column:
    """Month-ahead index rows that repeat the publication day get the real delivery end."""
    wrong = product.contains(V.MONTH_AHEAD_INDEX) & (pub_date == end_date)
    return F.when(wrong, last_day_of_next_month(pub_date)).otherwise(end_date)
