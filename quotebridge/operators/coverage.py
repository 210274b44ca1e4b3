"""Expected against landed feeds, and retrieval windows."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.functions.text import literal_array, token

FEED_KEY = ["pub_date", "hub", "product"]


def date_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from start to end, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("pub_date"))


def days_between(bounds: DataFrame) -> DataFrame:
    """The same for every (first_day, last_day) row of a DataFrame."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("pub_date"))


def expected_feeds(
    days: DataFrame,
    hubs: Sequence[str] = tuple(V.EXCHANGE_HUBS),
    products: Sequence[str] = tuple(V.EXCHANGE_PRODUCTS),
) -> DataFrame:
    """One row per day, hub and product folder that should have landed."""
    return days.withColumn("hub", F.explode(literal_array(list(hubs)))).withColumn(
        "product", F.explode(literal_array(list(products)))
    )


def feed_coverage(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected folders that have not landed.

    Landed rows are reduced to their folders first; both sides are then unique.
    """
    return expected.join(landed.select(*FEED_KEY).distinct(), FEED_KEY, "left_anti")


def landed_exchange_feeds(files: DataFrame) -> DataFrame:
    """(pub_date, hub, product) of landed exchange result files, from their names ``<kind>_<hub>_<yyyymmdd>.csv``."""
    name = F.col("file_name")
    product = F.when(name.startswith(V.SPOT_FILE_PATTERN), V.EXCHANGE_PRODUCTS[0]).when(
        name.startswith(V.FUTURES_FILE_PATTERN), V.EXCHANGE_PRODUCTS[1]
    )
    day = F.try_to_timestamp(F.regexp_extract(name, r"_([0-9]{8})[^_]*$", 1), F.lit("yyyyMMdd")).cast("date")
    return files.filter(name.contains(V.RESULT_FILE_MARK)).select(
        day.alias("pub_date"), F.lower(token(name, "_", -2)).alias("hub"), product.alias("product")
    ).filter(F.col("pub_date").isNotNull() & F.col("product").isNotNull())


def rolling_window(
    df: DataFrame, end: date | Column, column: str = "pub_date", days: int = V.DAYS_TO_RETRIEVE
) -> DataFrame:
    """Rows of the last ``days`` days up to ``end``."""
    last = end if isinstance(end, Column) else F.lit(end)
    return df.filter(F.col(column).between(F.date_sub(last, days), last))
