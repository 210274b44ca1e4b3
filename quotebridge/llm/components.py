"""Connected components by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebridge.llm.common import staged


def _pairs(df: DataFrame) -> DataFrame:
    """Undirected pairs with the larger node first, each once; loops and nulls go."""
    return df.select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).where("hi <> lo").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node points itself and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(smallest, "hi").select(F.col("lo").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(smallest.select(F.col("hi").alias("a"), F.col("m").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))"), F.sum(F.col("lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that occurs in the links ``a``, ``b`` (long), label the smallest node of its component.

    The links stay distributed; each round is written to the shared folder. Rounds grow with the logarithm
    of the longest path. No links: no rows.
    """
    edges = staged(_pairs(edges), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = staged(_pairs(_small_star(_pairs(_large_star(edges)))), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    return stars.unionAll(edges.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())
