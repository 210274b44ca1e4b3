"""Internally conflicting prices and simple price checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebridge import fixed_values as V
from quotebridge.operators.skew import salted_join

# Copies of a key are already counted together when keys are matched; few salts are enough.
_COUNTED_SALTS = 8


def inconsistent_quotes(df: DataFrame) -> DataFrame:
    """Keys quoted more than once with different prices."""
    return (
        df.groupBy("price_uk")
        .agg(
            F.min("price_mid").alias("min_price"),
            F.max("price_mid").alias("max_price"),
            F.count("price_mid").alias("no_prices"),
        )
        .filter((F.col("no_prices") > 1) & (F.col("min_price") != F.col("max_price")))
    )


def inconsistent_detail(df: DataFrame) -> DataFrame:
    """How often each price of a conflicting key occurs, by curve.

    Copies are counted before the keys are matched, so a key with many copies shrinks to its
    distinct prices first.
    """
    counted = df.groupBy(
        "price_uk", "src_price_id", "product_name", "pub_date", "end_date", "price_mid"
    ).agg(F.count("price_mid").alias("no_prices"))
    conflicts = (
        counted.groupBy("price_uk")
        .agg(
            F.min("price_mid").alias("_min"),
            F.max("price_mid").alias("_max"),
        )
        .filter(F.col("_min") != F.col("_max"))
        .select("price_uk")
    )
    return salted_join(counted, conflicts, ["price_uk"], "left_semi", _COUNTED_SALTS)


def conflicting_curves(df: DataFrame) -> DataFrame:
    """Month/season/quarter/year-ahead curves that take part in a conflicting key."""
    per_curve = df.groupBy("price_uk", "src_price_id").agg(
        F.min("price_mid").alias("_min"),
        F.max("price_mid").alias("_max"),
    )
    conflicts = (
        per_curve.groupBy("price_uk")
        .agg(F.min("_min").alias("_min"), F.max("_max").alias("_max"))
        .filter(F.col("_min") != F.col("_max"))
        .select("price_uk")
    )
    # Tied to an aggregate value on purpose: a filter on the curve alone would move below the
    # aggregation, and the two uses of ``per_curve`` could no longer share one shuffle.
    marked = F.col("src_price_id").rlike("|".join(V.CONFLICT_CURVE_MARKS))
    candidates = per_curve.filter(F.when(marked, F.col("_max") >= F.col("_min")))
    return (
        salted_join(candidates, conflicts, ["price_uk"], "left_semi", _COUNTED_SALTS)
        .select("src_price_id")
        .distinct()
    )


def drop_conflicting_curves(df: DataFrame) -> DataFrame:
    """Remove every quote of a conflicting curve, also on the days without a conflict."""
    return salted_join(df, conflicting_curves(df), ["src_price_id"], "left_anti")


def zero_prices(df: DataFrame) -> DataFrame:
    """Quotes at price zero, candidates for a correction at the source."""
    return (
        df.filter(F.col("price_mid") == 0)
        .select("price_uk", "src_price_id")
        .orderBy("src_price_id", "price_uk")
    )


def price_stats(df: DataFrame) -> DataFrame:
    price = F.col("price_mid").cast("double")
    return df.groupBy("currency", "unit").agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.avg(price).alias("avg_price"),
    )
