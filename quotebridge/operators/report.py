"""Reports and lookups over quotes and comparisons."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebridge import fixed_values as V


def _count_class(name: str) -> Column:
    return F.count_if(F.col("price_match") == name)


def daily_report(comparison: DataFrame) -> DataFrame:
    """One row with the match counts of a run; no row when nothing was compared."""
    return comparison.agg(
        F.date_format(F.max("comparison_date"), "yyyy-MM-dd").alias("comparison_date"),
        F.count("*").alias("no_prices_compared"),
        _count_class(V.MATCH).alias("no_price_matches"),
        _count_class(V.ROUNDING_MATCH).alias("no_price_matches_with_rounding_diff"),
        _count_class(V.MISMATCH).alias("no_price_mismatches"),
    ).filter(F.col("no_prices_compared") > 0)


def match_stats_by_date(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy("pub_date").agg(
        F.count("*").alias("total_prices"),
        _count_class(V.MATCH).alias("price_match"),
        _count_class(V.ROUNDING_MATCH).alias("price_rounding_diff"),
        _count_class(V.MISMATCH).alias("price_mismatch"),
    )


def daily_counts(comparison: DataFrame) -> DataFrame:
    """Compared prices per day, publication and class: what the statistics by day are sums of."""
    return comparison.groupBy("pub_date", "publication_name", "price_match").agg(F.count("*").alias("no_rows"))


def match_stats_of_counts(counts: DataFrame) -> DataFrame:
    """``match_stats_by_date`` from ``daily_counts``."""
    def of(name: str) -> Column:
        return F.sum(F.when(F.col("price_match") == name, F.col("no_rows")).otherwise(0))

    return counts.groupBy("pub_date").agg(
        F.sum("no_rows").alias("total_prices"), of(V.MATCH).alias("price_match"),
        of(V.ROUNDING_MATCH).alias("price_rounding_diff"), of(V.MISMATCH).alias("price_mismatch"),
    )


def volume_of_counts(counts: DataFrame, by: str) -> DataFrame:
    """Volumes per day and publication or class, from ``daily_counts``."""
    return counts.groupBy(F.col("pub_date").alias("publication_date"), by).agg(F.sum("no_rows").alias("number_of_prices"))


def volume_by_publication(comparison: DataFrame) -> DataFrame:
    return (
        comparison.groupBy(F.col("pub_date").alias("publication_date"), "publication_name")
        .agg(F.count("*").alias("number_of_prices"))
        .orderBy("publication_date", "publication_name")
    )


def volume_by_match(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy(F.col("pub_date").alias("publication_date"), "price_match").agg(
        F.count("*").alias("number_of_prices")
    )


def stage_metrics(**stages: DataFrame) -> DataFrame:
    """Row count per named stage, one row per stage, in one job."""
    counts = [
        df.agg(F.count("*").alias("no_rows")).select(F.lit(name).alias("stage"), "no_rows")
        for name, df in stages.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def flag_metrics(df: DataFrame, **stages: Column) -> DataFrame:
    """Rows that meet each named condition, one row per name, in one pass over ``df``."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in stages.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(name).alias("no_rows")) for name in stages])
    return counted.select(F.inline(rows))


def latest_pub_date(quotes: DataFrame) -> DataFrame:
    return quotes.agg(F.max("pub_date").alias("pub_date"))


def latest_pub_date_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes of the latest publication date; the date is one scalar subquery."""
    return quotes.filter(F.col("pub_date") == latest_pub_date(quotes).scalar())


def forward_curve(quotes: DataFrame, location: str, product: str | None = None) -> DataFrame:
    """Average price per relative period and delivery end on the latest publication date."""
    latest = latest_pub_date_quotes(quotes).filter(F.col("location_name") == location)
    if product is not None:
        latest = latest.filter(F.col("product_name") == product)
    return latest.groupBy("location_name", "period_rel", "end_date").agg(
        F.avg(F.col("price_mid").cast("double")).alias("avg_price")
    )


def lookup(
    df: DataFrame, order: Sequence[str], limit: int | None = None, **equals: object
) -> DataFrame:
    """Rows whose columns equal the given values, in a total order, optionally the first n."""
    for column, value in equals.items():
        df = df.filter(F.col(column) == F.lit(value))
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)
