"""Projections, unions and row validation around the canonical quote."""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebridge.functions.prices import price_key
from quotebridge.schema import KEY_PARTS, QUOTE, REQUIRED_QUOTE_COLUMNS


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row.

    Filters on an ordinary projection are rewritten into its expressions, which repeats long
    vocabulary rules for every filter. A one-row generator keeps later filters above it. It
    also gives the rules a generated method of their own, small enough for the JIT compiler;
    a method beyond 8000 bytes of code would run interpreted.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(c) for c in kept], F.inline(F.array(row)))


def to_canonical(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Project to the 20 canonical columns and types, building the price key if absent, and what is to be kept beside them.

    Columns the supplier does not deliver become NULL (never NaN).
    """
    keyed = df if "price_uk" in df.columns else with_computed(df, {"price_uk": price_key()})
    have = set(keyed.columns)
    return keyed.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in QUOTE
    ], *keep)


def with_ingestion_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_date", F.current_timestamp())


def partition_last(df: DataFrame, column: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != column], column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def is_complete() -> Column:
    """Every required field of the row is present."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED_QUOTE_COLUMNS])


def has_plain_key() -> Column:
    """No part of the key holds the '/' that parts its parts, so the key can be taken apart again."""
    parts = F.length("price_uk") - F.length(F.replace("price_uk", F.lit("/"), F.lit(""))) + 1
    return F.coalesce(parts == len(KEY_PARTS), F.lit(True))


def is_valid() -> Column:
    return is_complete() & has_plain_key()


def valid_quotes(df: DataFrame) -> DataFrame:
    """Quotes with every required field present and a key that can be taken apart."""
    return df.filter(is_valid())


def quarantine(df: DataFrame) -> DataFrame:
    """Quotes that miss a required field, or hold a '/' in a key part, with the list of missing fields and such parts."""
    missing = [F.when(F.col(c).isNull(), c) for c in REQUIRED_QUOTE_COLUMNS]
    slashed = [
        F.when(F.col(c).contains("/") & ~has_plain_key(), f"{c} holds /") for c in KEY_PARTS if not c.endswith("_date")
    ]
    return df.filter(~is_valid()).withColumn("missing_fields", F.array_join(F.array_compact(F.array(*missing, *slashed)), ","))


def union_present(
    spark: SparkSession, frames: Iterable[DataFrame | None], schema: T.StructType
) -> DataFrame:
    """Union of the inputs that exist; an empty frame when none does."""
    present = [f for f in frames if f is not None]
    if not present:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def all_quotes(*tables: DataFrame, distinct: bool = False) -> DataFrame:
    """One view over the supplier tables.

    The supplier label differs between tables, so a distinct can only remove repeats inside
    one table; it is off by default because it would shuffle every column.
    """
    union = reduce(lambda a, b: a.unionByName(b), tables)
    return union.dropDuplicates() if distinct else union
