"""Query scan over JDBC."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class DateSlices:
    """Split a remote query into slices of a date column, read by parallel tasks."""

    column: str
    start: str
    end: str
    slices: int


def jdbc_options(
    url: str, query: str, options: Mapping[str, str], slices: DateSlices | None = None
) -> dict[str, str]:
    """Reader options. Credentials and transport security come in through ``options``."""
    merged = {"url": url, **options}
    if slices is None:
        return {**merged, "query": query}
    return {
        **merged,
        "dbtable": f"({query}) q",
        "partitionColumn": slices.column,
        "lowerBound": slices.start,
        "upperBound": slices.end,
        "numPartitions": str(slices.slices),
    }


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    options: Mapping[str, str],
    slices: DateSlices | None = None,
) -> DataFrame:
    """Rows of a remote query; with ``slices`` one connection per date slice instead of one."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, options, slices)).load()
