"""Date-partitioned parquet tables.

All writes of a partitioned table go through a ``rebalance`` on the partition column: adaptive
execution then splits a day that is large and joins days that are small, so a hot day is not
one file written by one task and a quiet year is not thousands of files.

A replaced partition is written beside the table and swapped in at commit (Spark's dynamic
partition overwrite). A crash during the swap itself can leave some days replaced and others
not; running the same merge again gives the intended state, as every merge mode is idempotent.
"""

import uuid
from collections.abc import Sequence
from datetime import date
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebridge.operators.merge import (
    INSERT_ONLY,
    NEWER_WINS,
    changed_rows,
    merge_rows,
    require_unique,
)
from quotebridge.operators.shaping import partition_last

PARTITION = "pub_date"
#: Columns that rows are looked up by.
KEY_COLUMNS = ("price_uk", "endur_price_uk", "ext_price_uk")
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table. With a declared schema partition values keep its types; a day text is not read as a date."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_table_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    try:
        read_table(spark, path)  # an absent table has no schema to infer
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return None
        raise


def ensure_namespace(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Create the database at a fixed location when it is absent; return its description."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return spark.sql(f"DESCRIBE DATABASE `{name}`")


def register(spark: SparkSession, name: str, path: str) -> None:
    """Give a stored table a catalog name; an absent one is left out."""
    if read_table_or_none(spark, path) is None:
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A stored table to which columns were added: the columns of all its files, null where a file has none."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def conform(
    source: DataFrame, stored: T.StructType, partition: str, add_columns: bool = False, optional: Sequence[str] = ()
) -> DataFrame:
    """The source in the order of the stored columns; raises before anything is written when it does not fit them.

    Every stored column must be there with its type; the partition column takes the stored type, as its values are parts of
    paths. Columns that are not stored yet are refused, or come last when they are asked for; ``optional`` ones may
    be absent and are null then.
    """
    own = {f.name: f.dataType for f in source.schema}
    known = {f.name: f.dataType for f in stored}
    problems = [f"{c} is missing" for c in known if c not in own and c not in optional]
    problems += [
        f"{c} is {own[c].simpleString()}, not {known[c].simpleString()}" for c in known if c in own and c != partition and own[c] != known[c]
    ]
    added = [c for c in own if c not in known]
    if added and not add_columns:
        problems.append(f"{', '.join(added)} not stored")
    if problems:
        raise ValueError("source does not fit the stored table: " + "; ".join(problems))
    columns = [(F.col(c) if c in own else F.lit(None)).cast(known[c]).alias(c) for c in known]
    return source.select(*columns, *added)


def key_filters(keys: Sequence[str]) -> dict[str, str]:
    """Writer options that give every row group a bloom filter on the keys, of a size that fits its values.

    A lookup by key then skips the row groups that can't hold it, also where rows are sorted by other columns.
    """
    return {"parquet.bloom.filter.adaptive.enabled": "true"} | {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}


def _write(df: DataFrame, path: str, partition: str, mode: str, keys: Sequence[str] = ()) -> None:
    (
        df.hint("rebalance", partition)
        .write.mode(mode)
        .options(**key_filters([k for k in keys if k != partition]))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def overwrite_partition(df: DataFrame, path: str, partition: str = PARTITION, keys: Sequence[str] = ()) -> None:
    """Replace the partitions present in ``df``; other partitions stay; create if absent."""
    _write(partition_last(df, partition), path, partition, "overwrite", keys)


def touched_partitions(target: DataFrame, source: DataFrame, partition: str) -> DataFrame:
    """Target rows in the partitions of the source.

    The distinct values of the partition column are few; when their measured size is small Spark broadcasts
    them and prunes the target scan at run time.
    """
    return target.join(source.select(partition).distinct(), partition, "left_semi")


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    mode: str = NEWER_WINS,
    order_col: str = "src_last_update",
    partition: str = PARTITION,
    key_partition: Column | None = None,
    schema: T.StructType | None = None,
    add_columns: bool = False,
) -> None:
    """Upsert ``source`` into the table at ``path``; the first load creates the table.

    A source that does not fit the stored columns is refused before anything is written. With ``add_columns`` new columns
    are stored as well (read such a table with ``read_evolved``).

    A row never moves between partitions: the partition column is part of the key, or is determined by it.
    ``key_partition`` gives the partition value as an expression over the key; the job fails at the first row
    that leaves its partition. Only partitions that occur in the source are read and rewritten; an insert-only
    merge just appends.
    """
    if key_partition is not None:
        wrong = ~F.coalesce(key_partition.eqNullSafe(F.col(partition)), F.lit(False))
        message = F.concat(F.lit("a key leaves its partition: "), F.concat_ws(" | ", *[F.col(k).cast("string") for k in keys]))
        source = source.filter(F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(True))
    target = read_table_or_none(spark, path, schema)
    if target is None:
        _write(partition_last(require_unique(source, keys), partition), path, partition, "append", keys)
        return
    if add_columns:
        target = read_evolved(spark, path)
    source = conform(source, target.schema, partition, add_columns)
    target = target.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in source.schema if f.name not in target.columns
    })
    current = touched_partitions(target, source, partition)
    on = [*keys] if partition in keys else [*keys, partition]
    if mode == INSERT_ONLY:
        new = changed_rows(current, source, on, mode, keys[0])
        _write(partition_last(new, partition), path, partition, "append", keys)
        return
    merged = merge_rows(current, source, on, mode, order_col)
    overwrite_partition(merged, path, partition, keys)


def create_bucketed(
    source: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, partition: str = PARTITION
) -> None:
    """A catalog table at ``path`` whose rows are dealt into buckets by their keys and sorted in them, by partition.

    Every task of the write holds one bucket, so a partition gets one file per bucket.
    """
    (
        partition_last(require_unique(source, keys), partition)
        .repartition(buckets, *keys)
        .write.options(**key_filters(keys))
        .option("path", path)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name, format="parquet")
    )


def bucketed_merge(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], mode: str = NEWER_WINS,
    order_col: str = "src_last_update", partition: str = PARTITION,
) -> DataFrame:
    """Rows of the touched partitions of a bucketed table after the merge.

    The stored side is read bucket by bucket and does not move; only the source is shuffled, into the same buckets. The keys
    determine the partition, so they alone are joined on.
    """
    target = spark.table(name)
    fitted = conform(source, target.schema, partition)
    return merge_rows(touched_partitions(target, fitted, partition), fitted, keys, mode, order_col)


def merge_into_bucketed(
    spark: SparkSession, name: str, path: str, source: DataFrame, keys: Sequence[str], buckets: int, mode: str = NEWER_WINS,
    order_col: str = "src_last_update", partition: str = PARTITION,
) -> None:
    """Upsert into a bucketed table; the first load creates it. The number of buckets is fixed then."""
    if not spark.catalog.tableExists(name):
        create_bucketed(source, name, path, keys, buckets, partition)
        return
    merged = bucketed_merge(spark, name, source, keys, mode, order_col, partition)
    merged.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)


def write_history(changes: DataFrame, path: str, version: int) -> None:
    """Store the changed rows of one run under their version number; a version is written once.

    Running the same version again replaces it.
    """
    numbered = changes.withColumn("version", F.lit(version))
    (
        numbered.hint("rebalance").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)
    )


def replace_load(df: DataFrame, path: str, load_id: str) -> None:
    """Store the rows of one load in its own partition ``load_id``; the same load again replaces them, also by none."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/load_id={quote(load_id, safe='')}")


def small_file_partitions(
    spark: SparkSession, path: str, partition: str = PARTITION, file_bytes: int | None = None
) -> DataFrame:
    """Partitions with more files than their bytes need: (partition, files, bytes). Reads no row."""
    return partition_sizes(spark, path, partition).filter(F.col("files") > files_for(F.col("bytes"), file_bytes or advisory_bytes(spark)))


def advisory_bytes(spark: SparkSession) -> int:
    """The size that the session advises for a task's share: one task, one file."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def files_for(size: Column, file_bytes: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / file_bytes))


def partition_sizes(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """(partition, files, bytes) from the listing and the files' sizes."""
    files = read_table(spark, path).select(
        partition, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size")
    ).dropDuplicates([partition, "f"])
    return files.groupBy(partition).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def compact(
    spark: SparkSession,
    path: str,
    days: Sequence[date] | None = None,
    partition: str = PARTITION,
    sort_by: Sequence[str] = ("location_name", "price_uk"),
    file_bytes: int | None = None,
) -> None:
    """Rewrite partitions as few, sorted files: those given, else those that have too many files.

    ``file_bytes`` (by default the session's advisory size) alone says how many files the bytes of a partition need; its rows are
    dealt into as many parts, each one file. So what was compacted is not listed again, a large day becomes several files, and small days share a task.
    """
    sizes = partition_sizes(spark, path, partition).withColumn("parts", files_for(F.col("bytes"), file_bytes or advisory_bytes(spark)))
    chosen = sizes.filter(F.col(partition).isin(list(days))) if days is not None else sizes.filter(F.col("files") > F.col("parts"))
    rows = partition_last(read_table(spark, path), partition).join(chosen.select(partition, "parts"), partition)
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*sort_by), F.col("parts"))).repartition(partition, "_part")
    (
        partition_last(dealt.sortWithinPartitions(partition, *sort_by).drop("_part", "parts"), partition)
        .write.mode("overwrite")
        .options(**key_filters([c for c in sort_by if c in KEY_COLUMNS]))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def export_files(df: DataFrame, path: str) -> None:
    """Export for a reporting tool as a folder of parquet files; any size."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def export_report(df: DataFrame, folder: str, name: str) -> None:
    """Export the daily report as one parquet file with a fixed name.

    The report has one row per day by its key, so one file is one small task; everything else goes through
    ``export_files``.
    """
    if "comparison_date" not in df.columns:
        raise ValueError("only the daily report is exported as a single file")
    spark = df.sparkSession
    scratch = f"{folder.rstrip('/')}/_export-{uuid.uuid4().hex}"
    df.coalesce(1).write.mode("overwrite").parquet(scratch)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = fs.globStatus(hadoop_path(f"{scratch}/part-*.parquet"))[0].getPath()
    final = hadoop_path(f"{folder.rstrip('/')}/{name}")
    fs.delete(final, False)
    fs.rename(part, final)
    fs.delete(hadoop_path(scratch), True)
