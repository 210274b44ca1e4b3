"""Helpers of the training-data operators.

Words are runs of bytes other than the six ASCII blanks (space, tab, line feed, vertical tab, form feed,
carriage return): exactly what ``bytes.split()`` yields, and the only letters folded are A to Z,
exactly what ``bytes.lower()`` folds.
"""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebridge.sinks.staging import new_folder

BLANKS = r"[\x20\x09-\x0D]+"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Largest side that is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table of few columns with a broadcast hint if it has at most ``limit`` rows, else unchanged."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null gives empty bytes."""
    for start in range(0, len(column), 256):
        for value in column.slice(start, 256).cast(pa.large_binary()).to_pylist():
            yield value or b""


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function of a task; at its end, freed memory goes back to the system.

    Python workers stay for the stages that follow, beside those of the JVM on the same executor.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def fold(column):
    """A to Z in lower case, all other letters as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, some of them at a time: about ``size`` bytes, cut at blanks."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + size)
        end = blank.start() if blank else len(text)
        yield text[at:end].split()
        at = end
