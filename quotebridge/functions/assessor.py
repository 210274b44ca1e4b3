"""Vocabulary of the price-reporting-agency feed."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.functions.text import first_match, literal_array, token, value_map


def hub(location_name: Column) -> Column:
    return value_map(location_name, V.ASSESSOR_HUB_NAMES)


def duration(timeframe: Column) -> Column:
    first_word = token(token(timeframe, " ", 0), "-", 0)
    return first_match(
        [
            (timeframe.contains("Month"), F.lit("Month")),
            (timeframe.contains("WDNW"), F.lit("Week")),
        ],
        first_word,
    )


def relative_period(timeframe: Column) -> Column:
    """'Month +1' -> 'M01', 'Month +10' -> 'M10', 'Day-Ahead' -> 'D01', BOM -> 'M00'."""
    code = timeframe
    for old, new in V.RELATIVE_PERIOD_CODES:
        code = F.replace(code, F.lit(old), F.lit(new))
    code = F.when(code.contains("BOM"), "M00").otherwise(code)
    # A zero three places from the end is padding left over from '+'.
    return F.regexp_replace(code, r"0(..)$", "$1")


def index_words(price_id: Column) -> Column:
    """Descriptive words of the last id segment, capitalised, in order.

    Compute this once per row and hand the column to the rules below.
    """
    segments = F.split(token(price_id, "/", -1), "-")
    kept = F.filter(segments, lambda w: w.isin(V.INDEX_ID_WORDS))
    return F.transform(kept, lambda w: F.initcap(w))


def index_product(words: Column) -> Column:
    subject = F.filter(words, lambda w: ~w.isin(V.INDEX_TYPE_WORDS))
    kind = first_match(
        [
            (F.array_contains(words, "Spot"), literal_array(["Spot Index"])),
            (F.array_contains(words, "Cumulative"), literal_array(["Cumulative Index"])),
        ],
        literal_array(["Index"]),
    )
    return F.array_join(F.concat(subject, kind), " ")


def _mentions(words: Column, stem: str) -> Column:
    return F.array_join(words, " ").contains(stem)


def index_duration(words: Column) -> Column:
    return first_match(
        [
            (_mentions(words, "Month"), F.lit("Month")),
            (_mentions(words, "Weekend"), F.lit("Weekend")),
            (_mentions(words, "Day"), F.lit("Day")),
        ]
    )


def index_period_rel(words: Column) -> Column:
    day = F.when(_mentions(words, "Within"), "D00").otherwise("D01")
    return first_match(
        [
            (_mentions(words, "Month"), F.lit("M01")),
            (_mentions(words, "Weekend"), F.lit("WKD")),
            (_mentions(words, "Day"), day),
        ]
    )


def currency(name: Column) -> Column:
    return first_match(
        [(name.contains("Pence"), F.lit("GBp")), (name.contains("Euro"), F.lit("EUR"))], name
    )


def is_rolled_balance_of_month(period_abs: Column, pub_date: Column, end_date: Column) -> Column:
    """Balance-of-month quotes that already point at a later month."""
    return (period_abs == "BOM") & (F.trunc(pub_date, "MM") < F.trunc(end_date, "MM"))
