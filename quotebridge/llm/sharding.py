"""Sharding by fixed virtual slots.

Records are hashed into ``SLOTS`` slots, by doc_id and text. Bytes are summed per slot (a fixed number of rows, whatever the data),
and a versioned table maps slots to shards. Version 1 deals the slots out in turn; each later version edits the one before:
slots move from the largest shard to the smallest as long as that brings the two nearer, so the law that holds is
``bytes``: sizes near equal. Records never move between slots. With ``map_path`` the map is kept: a run reads the latest stored
version, appends the edited one if the sizes ask for an edit, and only slots that it names move.

Records that repeat so often that they would fill a slot alone (at most ``slots`` of them, by arithmetic) are dealt over
copies of their hash by their place in the input, so that one id or one text that holds half of all rows is spread like
any other rows.

A row's place in its shard (``slot`` of the query) is its rank within a bucket of its virtual slot plus the rows of the
buckets before. Buckets get finer with the number of rows, so no task numbers a whole shard.

Defined results: null text has size 8 and counts as empty; repeated rows get places of their own; an
empty table gives no rows and a map without moves; only doc_id and text are read.
"""

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import staged

SLOTS = 4096
SHARDS = 24
ROW_BYTES = 8
#: Rows that one task numbers at a time.
BUCKET_ROWS = 50_000

Map = dict[int, int]


def hash_of() -> Column:
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, record: hash of the row, copy: its place in the input)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        hash_of().alias("record"), F.monotonically_increasing_id().alias("copy"),
    )


def frequent(rows: DataFrame, slots: int) -> DataFrame:
    """(record, often: true) of the records that hold more than a slot's share of all bytes: fewer than ``slots``."""
    total = rows.agg(F.sum("size").alias("total"))
    held = rows.groupBy("record").agg(F.sum("size").alias("held"), F.count("*").alias("n")).where("n > 1")
    share = total.scalar() / F.lit(slots)
    return staged(held.where(F.col("held") > share).select("record", F.lit(True).alias("often")), "frequent-records")


def slotted(rows: DataFrame, often: DataFrame, slots: int) -> DataFrame:
    """Adds ``hash`` and ``vslot`` to rows with ``record`` and ``copy``."""
    marked = rows.join(F.broadcast(often), "record", "left")
    mixed = F.when(F.col("often"), F.xxhash64("record", "copy")).otherwise(F.col("record"))
    return marked.withColumn("hash", mixed).withColumn("vslot", F.pmod("hash", F.lit(slots)).cast("int")).drop("record", "copy", "often")


def slot_totals(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each used slot; at most as many entries as there are slots."""
    found = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    return {r["vslot"]: (r["bytes"], r["rows"]) for r in found}


def first_map(slots: int, shards: int) -> Map:
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(current: Map, sizes: dict[int, int], shards: int) -> Map:
    """The next version: slots move from the largest to the smallest shard while that shrinks their difference."""
    edited = dict(current)
    loads = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in sorted(edited.items()):
        loads[shard] += sizes.get(slot, 0)
        if sizes.get(slot, 0):
            held[shard].append((sizes[slot], slot))
    heap = [(-load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    while heap:
        load, largest = heapq.heappop(heap)
        if -load != loads[largest]:
            continue
        smallest = min(range(shards), key=lambda s: (loads[s], s))
        gap = loads[largest] - loads[smallest]
        fitting = [x for x in held[largest] if x[0] < gap]
        if not fitting:
            continue  # this shard can't be improved further: the next largest
        size, slot = min(fitting, key=lambda x: (abs(2 * x[0] - gap), x[1]))
        held[largest].remove((size, slot))
        held[smallest].append((size, slot))
        edited[slot] = smallest
        for shard, change in ((largest, -size), (smallest, size)):
            loads[shard] += change
            heapq.heappush(heap, (-loads[shard], shard))
    return edited


def map_table(spark: SparkSession, versions: dict[int, Map]) -> DataFrame:
    """(version, vslot, shard)."""
    rows = [(v, slot, shard) for v, one in versions.items() for slot, shard in sorted(one.items())]
    return spark.createDataFrame(rows, "version int, vslot int, shard int")


def mapped(
    spark: SparkSession, sizes: dict[int, int], shards: int, slots: int, map_path: str | None = None
) -> tuple[int, DataFrame]:
    """The latest version after this run, and the table of all versions.

    Without a stored map the first version deals the slots out. A version is added only if it differs from the one before.
    """
    stored = None if map_path is None else stored_map(spark, map_path)
    if stored is None:
        first = first_map(slots, shards)
        versions = {1: first, 2: rebalanced(first, sizes, shards)}
        latest = 2
    else:
        latest = stored.agg(F.max("version")).first()[0]
        current = {r["vslot"]: r["shard"] for r in stored.where(F.col("version") == latest).collect()}  # one row a slot
        if set(current) != set(range(slots)):
            raise ValueError(f"the stored map has {len(current)} slots, not {slots}: the number of slots is fixed")
        edited = rebalanced(current, sizes, shards)
        versions = {} if edited == current else {latest + 1: edited}
        latest = max(versions, default=latest)
    new = map_table(spark, versions)
    if map_path is None:
        return latest, staged(new, "slot-map")
    if versions:
        new.coalesce(1).write.mode("append").parquet(map_path)
    return latest, stored_map(spark, map_path)


def stored_map(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def sharded(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot, map_version."""
    spark = docs.sparkSession
    records = staged(sized(docs), "sized")
    rows = slotted(records, frequent(records, slots), slots)
    totals = slot_totals(rows)
    version, versions = mapped(spark, {s: b for s, (b, _) in totals.items()}, shards, slots, map_path)
    latest = versions.where(F.col("version") == version)
    finer = max(1, -(-sum(n for _, n in totals.values()) // (slots * BUCKET_ROWS)))
    bucketed = rows.withColumn("bucket", F.pmod(F.shiftright("hash", 20), F.lit(finer)).cast("int"))
    counts = bucketed.groupBy("vslot", "bucket").agg(F.count("*").alias("rows")).join(F.broadcast(latest), "vslot")
    before = Window.partitionBy("shard").orderBy("vslot", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "vslot", "bucket", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("vslot", "bucket").orderBy("doc_id", "text_crc32", "size")
    placed = bucketed.withColumn("rank", F.row_number().over(within)).join(offsets, ["vslot", "bucket"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"), F.col("version").alias("map_version"),
    )


def assigned(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """The documents with all their columns, ``shard`` and ``virtual_slot`` (columns of these names are replaced)."""
    records = staged(sized(docs.select("doc_id", "text")), "sized")
    often = frequent(records, slots)
    totals = slot_totals(slotted(records, often, slots))
    version, versions = mapped(docs.sparkSession, {s: b for s, (b, _) in totals.items()}, shards, slots, map_path)
    latest = versions.where(F.col("version") == version).select(F.col("vslot").alias("virtual_slot"), "shard")
    own = docs.drop("shard", "virtual_slot")
    row = own.select(F.struct(*own.columns).alias("row"), hash_of().alias("record"), F.monotonically_increasing_id().alias("copy"))
    placed = slotted(row, often, slots).select("row.*", F.col("vslot").alias("virtual_slot"))
    return placed.join(F.broadcast(latest), "virtual_slot")
