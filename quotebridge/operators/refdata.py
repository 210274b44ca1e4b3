"""Internal quote extract from the trading system's reference-data star."""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.operators.skew import salted_join


def latest_version(definitions: DataFrame) -> DataFrame:
    """Rows at the highest version of their curve, taken over all versions.

    A curve has few versions, so no curve is hot and one window over the curve is enough.
    """
    newest = F.max("index_version_id").over(Window.partitionBy("index_id"))
    return (
        definitions.filter(F.col("index_id").isNotNull())
        .withColumn("_newest", newest)
        .filter(F.col("index_version_id") == F.col("_newest"))
        .drop("_newest")
    )


def is_source_curve(index_name: str = "index_name"):
    name = F.lower(index_name)
    return name.contains(V.SOURCE_CURVE_MARKS[0]) | name.contains(V.SOURCE_CURVE_MARKS[1])


def internal_extract(
    definitions: DataFrame,
    currencies: DataFrame,
    units: DataFrame,
    prices: DataFrame,
    sources: DataFrame,
    delivery_types: DataFrame,
    start: date,
    end: date,
) -> DataFrame:
    """Quotes of the current, active, relevant curves in the reset-date window.

    The curve side is reduced first; the price history is then joined to it and to the
    publication names with salted joins, as one curve or publication may hold a large
    share of the history. No side is forced to broadcast.
    """
    curves = (
        latest_version(definitions)
        .filter((F.col("db_status") == 1) & is_source_curve())
        .join(currencies.select(F.col("id_number").alias("currency"),
                                F.col("name").alias("currency_name")), "currency")
        .join(units.select(F.col("unit_id").alias("unit"), "unit_label"), "unit")
        .join(delivery_types.select(F.col("id_number").alias("delivery_type"),
                                    F.col("name").alias("commodity")), "delivery_type")
        .select("index_id", "index_name", "commodity", "currency_name", "unit_label")
    )
    window = prices.filter(F.col("reset_date").between(F.lit(start), F.lit(end)))
    publications = sources.select(
        F.col("id_number").alias("ref_source"), F.col("name").alias("publication")
    )
    quoted = salted_join(window, curves, ["index_id"])
    named = salted_join(quoted, publications, ["ref_source"])
    return named.select(
        "commodity",
        "index_name",
        "publication",
        F.col("reset_date").alias("pub_date"),
        F.col("start_date").alias("end_date"),
        "price",
        F.col("currency_name").alias("currency"),
        F.col("unit_label").alias("unit"),
        "last_update",
    )
