"""Shared folder for intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a folder of its own, once."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quotebridge-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, path: str, spread: bool = True) -> DataFrame:
    (df.hint("rebalance") if spread else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a result that several outputs of one run share, and read it back.

    Every output then sees the same rows, and a lost executor costs a re-read, not a re-run.
    """
    return _stored(df, new_folder(df.sparkSession, name))


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def stages(spark: SparkSession) -> Iterator:
    """``with stages(spark) as stage: df = stage(df, "name")``: staged tables that go when the job ends.

    Rows that are observed are stored with ``spread=False``: the writing tasks themselves are then observed. Spark counts
    each of those once, whereas a task before a shuffle counts again when a lost executor makes it run again.
    """
    paths: list[str] = []

    def stage(df: DataFrame, name: str = "stage", spread: bool = True) -> DataFrame:
        paths.append(new_folder(spark, name))
        return _stored(df, paths[-1], spread)

    try:
        yield stage
    finally:
        for path in paths:
            remove_folder(spark, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLES, None)
    spark.conf.set(SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES)
        else:
            spark.conf.set(SHUFFLES, before)
