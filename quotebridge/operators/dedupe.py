"""Keep one quote per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Newest first, then a total order over everything that can still differ inside a key.
NEWEST_FIRST: list[Column | str] = [
    "src_last_update", "src_price_id", "price_mid", "start_date", "period_rel", "period_abs",
    "price_bid", "price_offer", "data_source",
]


def newest_first() -> list[Column]:
    latest, *ties = NEWEST_FIRST
    return [F.col(latest).desc(), *[F.col(c).asc() for c in ties]]


def dedupe_quotes(
    df: DataFrame,
    keys: Sequence[str] = ("price_uk",),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """First row per key in a total order.

    ``row_number() = 1`` lets Spark drop all but one row per key inside each task before the
    shuffle, so a key with very many copies reaches its reducer as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or newest_first()))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
