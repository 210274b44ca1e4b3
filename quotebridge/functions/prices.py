"""Price parsing, match classes and the unique price key."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.schema import KEY_PARTS

_NUMBER = r"^\s*[+-]?[0-9]+([.,][0-9]+)?([eE][+-]?[0-9]+)?\s*$"


def parse_price(text: Column, decimals: int = 4) -> Column:
    """Number written with a decimal comma or point; anything else (NaN, Infinity, suffixes) becomes null.

    Half-even rounding keeps the last digit where a binary-float rounding would.
    """
    number = F.when(F.regexp_like(text, F.lit(_NUMBER)), F.replace(text, F.lit(","), F.lit("."))).try_cast("double")
    return F.bround(number, decimals)


def day_of(text: Column) -> Column:
    """Calendar day that a date or timestamp text names, in any session zone; null when it is neither."""
    return F.when(text.try_cast("timestamp").isNotNull(), F.substring(F.trim(text), 1, 10)).try_cast("date")


def price_difference(left: Column, right: Column, decimals: int) -> Column:
    """Absolute difference of two stored (32-bit) prices, computed in 64 bits."""
    return F.round(F.abs(left.cast("double") - right.cast("double")), decimals)


def match_class(left: Column, right: Column) -> Column:
    """Exact / rounding / mismatch; a missing price on either side is a mismatch."""
    diff = price_difference(left, right, V.MATCH_DECIMALS)
    return (
        F.when(diff == 0, V.MATCH)
        .when(diff <= V.MATCH_THRESHOLD, V.ROUNDING_MATCH)
        .otherwise(V.MISMATCH)
    )


def binary_match_class(left: Column, right: Column) -> Column:
    """The earlier two-way class with its own threshold."""
    diff = price_difference(left, right, V.OLD_MATCH_DECIMALS)
    return F.when(diff > V.OLD_MATCH_THRESHOLD, V.OLD_MISMATCH).otherwise(V.OLD_MATCH)


def price_key(**replaced: Column) -> Column:
    """Ten key parts joined by '/'. A null part makes the whole key null.

    Keyword arguments replace single parts, e.g. ``price_key(period_duration=...)``.
    """
    parts: list[Column] = []
    for name in KEY_PARTS:
        part = replaced.get(name, F.col(name))
        if name.endswith("_date"):
            part = F.date_format(part, "yyyy-MM-dd")
        parts += [part, F.lit("/")]
    return F.concat(*parts[:-1])
