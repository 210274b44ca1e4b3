"""Vocabulary of the exchange feed."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.functions.text import token


def spot_period_rel(product: Column) -> Column:
    return F.when(product.contains("WEEKEND"), "WKD").otherwise("DA01")


def spot_product(product: Column) -> Column:
    return F.when(product.contains("EGSI"), "EGSI").otherwise("EOD")


def spot_duration(period_rel: Column) -> Column:
    return F.when(period_rel.contains("DA01"), "Day").otherwise("Weekend")


def last_delivery_day(end_date: Column) -> Column:
    """Spot files give the day after delivery."""
    return F.date_sub(end_date, 1)


def granularity(product: Column) -> Column:
    """Second-to-last word of a futures product name."""
    return token(product, " ", -2)


def price_unit(raw: Column) -> Column:
    """The files label pence prices as pounds; correct the label."""
    return F.when(raw.isin(V.PENCE_UNITS), V.PENCE_UNIT).otherwise(raw)


def currency(raw_price_unit: Column) -> Column:
    return token(price_unit(raw_price_unit), "/", 0)


def unit(raw_price_unit: Column) -> Column:
    return token(price_unit(raw_price_unit), "/", 1)
