"""Landing layout ``<root>/ingest_date=<day>/source=<name>``, what lies in it, and the internal feed in it."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebridge.schema import RAW_INTERNAL


def landing_path(root: str, ingest_date: date | str, source: str) -> str:
    return f"{root.rstrip('/')}/ingest_date={ingest_date}/source={source}"


def landing_glob(root: str, source: str) -> str:
    """Folders of a source over all days."""
    return landing_path(root, "*", source)


def landing_paths(root: str, source: str, start: date, end: date) -> list[str]:
    """Folders of a source from start to end, both included; at most one path a day."""
    return [landing_path(root, start + timedelta(n), source) for n in range((end - start).days + 1)]


def landed_files(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    """(file_path, file_name, file_bytes, landed_at, ingest_date, source) of every landed file; no content is read."""
    folders = root.rstrip("/") if source is None else landing_glob(root, source)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    path = F.col("path")
    return files.select(
        path.alias("file_path"), F.substring_index(path, "/", -1).alias("file_name"), F.col("length").alias("file_bytes"),
        F.col("modificationTime").alias("landed_at"),
        F.regexp_extract(path, "/ingest_date=([^/]*)/", 1).try_cast("date").alias("ingest_date"),
        F.regexp_extract(path, "/source=([^/]*)/", 1).alias("source"),
    )


def write_landing(df: DataFrame, root: str, ingest_date: date | str, source: str) -> None:
    """Replace one landing directory."""
    df.write.mode("overwrite").parquet(landing_path(root, ingest_date, source))


def read_internal(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Internal bronze rows of one directory or several, read with the declared schema."""
    return spark.read.schema(RAW_INTERNAL).parquet(*([path] if isinstance(path, str) else path))


def read_landing(
    spark: SparkSession,
    root: str,
    schema: T.StructType = RAW_INTERNAL,
    ingest_date: date | None = None,
    source: str | None = None,
) -> DataFrame:
    """Landed parquet rows over many days; day and source prune directories."""
    layout = T.StructType([
        *schema.fields,
        T.StructField("ingest_date", T.DateType()),
        T.StructField("source", T.StringType()),
    ])
    df = spark.read.schema(layout).parquet(root)
    if ingest_date is not None:
        df = df.filter(F.col("ingest_date") == F.lit(ingest_date))
    if source is not None:
        df = df.filter(F.col("source") == source)
    return df
