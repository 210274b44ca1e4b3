"""Joins and flags that stay balanced when one key holds a large share of the rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 32
_SALT = "_salt"


def _task_salt(salts: int) -> Column:
    """Salt by task, so that even identical rows of one key are spread.

    A repeated task keeps its number, hence a lost executor does not move rows between
    reducers the way a random salt would.
    """
    return F.pmod(F.spark_partition_id(), F.lit(salts))


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Equi-join whose ``large`` side may be skewed on ``on``.

    Each hot key of ``large`` is spread over ``salts`` reducers; ``small`` (one row per key, or
    few) is repeated once per salt. No broadcast is forced: when the measured size of
    ``small`` is below the session's threshold Spark broadcasts it and no row moves.
    """
    spread = large.withColumn(_SALT, _task_salt(salts))
    repeated = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*on, _SALT], how).drop(_SALT)


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], salts: int = DEFAULT_SALTS
) -> DataFrame:
    """Add ``is_duplicate`` (key occurs more than once) and ``is_repeat`` (not the first row).

    Two passes: rank inside (key, salt), then rank only the first row of each salt against
    each other. A group is never sorted by one task, and both windows stream.
    """
    ordered = list(order)
    within = Window.partitionBy(*keys, _SALT).orderBy(*ordered)
    across = Window.partitionBy(*keys, "_group").orderBy(*ordered)
    ranked = (
        df.withColumn(_SALT, _task_salt(salts))
        .withColumn("_is_head", F.row_number().over(within) == 1)
        .withColumn("_has_next", F.lead(F.lit(1)).over(within).isNotNull())
        .withColumn("_group", F.when(F.col("_is_head"), -1).otherwise(F.col(_SALT)))
        .withColumn("_later_head", F.row_number().over(across) > 1)
        .withColumn("_next_head", F.lead(F.lit(1)).over(across).isNotNull())
    )
    repeat = ~F.col("_is_head") | F.col("_later_head")
    return (
        ranked.withColumn("is_duplicate", repeat | F.col("_has_next") | F.col("_next_head"))
        .withColumn("is_repeat", repeat)
        .drop(_SALT, "_is_head", "_has_next", "_group", "_later_head", "_next_head")
    )
