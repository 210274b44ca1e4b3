"""Token counts by scanning flat token files for end-of-document identifiers.

A flat token file is a run of fixed-width unsigned little-endian identifiers without an index, cut into blocks at arbitrary
token positions: rows (file, block, tokens binary). ``written`` tokenizes a table into such files, one per input split;
``flat_blocks`` cuts files that other tools wrote. The scan looks at each block once and alone, with one vectorised search
for the separator: separators, tokens before the first, between neighbours, and after the last. A document that crosses
blocks is stitched by a segmented prefix scan over these small summaries in two levels (blocks in a group, groups in a file),
so neither a file nor a document has to fit a task.

Defined results: null and empty texts are documents of 0 tokens; tokens after the last separator of a file are one more
document, marked ``closed`` = false; an empty block changes nothing; files that hold no separator have only an open
document; an empty table gives no rows; repeated rows are documents of their own; only doc_id and text are read.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotebridge.llm.common import staged

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The first identifier after those of the vocabulary.
SEPARATOR = 50_256
BLOCK_TOKENS = 1 << 18
GROUP_BLOCKS = 1024
#: Fixed value: how byte-pair tokenizers of this family cut a text before merging.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte pieces and their identifiers; the size of a vocabulary, not of the data."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def written(docs: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Flat token files of the documents: (file, block, tokens, ends).

    ``ends`` lists the doc_ids whose separators lie in the block, as the tokenizer's log of what it wrote; the scan
    doesn't look at it. Stored, as the split into files must not change between scans.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value).encode_to_numpy
        parts: list[np.ndarray] = []
        ends: list[tuple[int, int | None]] = []
        size = start = block = 0
        stop = np.array([SEPARATOR], np.uint16)

        def cut(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, ends, size, start, block
            stream = np.concatenate(parts) if parts else np.empty(0, np.uint16)
            while len(stream) >= block_tokens or (whole and len(stream)):
                own = [i for at, i in ends if at < start + block_tokens]
                yield pa.record_batch({
                    "block": pa.array([block], pa.int64()), "tokens": pa.array([stream[:block_tokens].tobytes()], pa.binary()),
                    "ends": pa.array([own], pa.list_(pa.int64())),
                })
                ends = ends[len(own):]
                stream = stream[block_tokens:]
                start, block = start + block_tokens, block + 1
            parts, size = [stream], len(stream)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = encode(text or "", allowed_special=set(), disallowed_special=()).astype(np.uint16)
                parts += [own, stop]
                size += len(own) + 1
                ends.append((start + size - 1, doc_id))
                if size >= block_tokens:
                    yield from cut(False)
        yield from cut(True)

    blocks = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "block long, tokens binary, ends array<long>")
    return staged(blocks.select(F.spark_partition_id().cast("string").alias("file"), "block", "tokens", "ends"), "token-files", "zstd")


def flat_blocks(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, tokens) of flat files of identifiers of ``width`` bytes; bytes after the last whole one are left out.

    Each file is read by one task before it is cut, so a file should be a shard of at most some hundred megabytes.
    """
    step = block_tokens * width
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), "content", ((F.col("length") - F.col("length") % width) / step).alias("steps"), "length"
    )
    last = F.greatest(F.lit(0), F.ceil("steps") - 1)
    cut = files.where(F.col("length") >= width).select("file", "content", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    size = F.least(F.lit(step).cast("long"), F.expr(f"length - length % {width} - block * {step}"))
    return cut.select("file", "block", F.substring("content", (F.col("block") * step + 1).cast("int"), size.cast("int")).alias("tokens"))


def summaries(blocks: DataFrame, separator: int, width: int) -> DataFrame:
    """(file, block, more columns, n, head, tail, inner): separators, tokens before the first and after the last, lengths between."""
    others = [c for c in blocks.columns if c not in ("file", "block", "tokens")]
    kinds = dict(blocks.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["file", "block", *others]) + ", n long, head long, tail long, inner array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for payload in batch["tokens"]:
                found = np.frombuffer(payload.as_buffer() or b"", dtype=f"<u{width}")
                at = np.flatnonzero(found == separator)
                if len(at):
                    rows.append((len(at), int(at[0]), len(found) - int(at[-1]) - 1, np.diff(at) - 1))
                else:
                    rows.append((0, len(found), len(found), np.empty(0, np.int64)))
            n, head, tail, inner = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = [batch[c] for c in ["file", "block", *others]] + [pa.array(x, pa.int64()) for x in (n, head, tail)]
            columns.append(pa.array(list(inner), pa.list_(pa.int32())))
            yield pa.record_batch(columns, names=["file", "block", *others, "n", "head", "tail", "inner"])

    return blocks.mapInArrow(run, schema)


def _carried(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds, over earlier rows of the group, ``docs`` (separators) and ``carry`` (tokens since the last one).

    ``seg`` numbers runs that begin at a row with a separator; what is open after a row is the sum of the tails of its run.
    """
    window = Window.partitionBy(*group).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.withColumn("seg", F.sum((F.col("n") > 0).cast("long")).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy(*group, "seg").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    opened = runs.withColumn("open", F.sum("tail").over(within))
    return opened.withColumns({
        "docs": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "carry": F.coalesce(F.lag("open").over(window), F.lit(0)),
        "bare": F.coalesce(F.max(F.col("n") > 0).over(earlier), F.lit(False)) == F.lit(False),
    })


def scanned(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """One row per block: (file, block, more columns, docs: documents before it, lengths: of those ending in it, n, open)."""
    parts = staged(summaries(blocks, separator, width).withColumn("grp", F.expr(f"block div {GROUP_BLOCKS}")), "block-summaries")
    inside = _carried(parts, ["file", "grp"], "block")
    groups = parts.groupBy("file", "grp").agg(
        F.sum("n").alias("n"),
        F.sum("tail").alias("all_tail"), F.max(F.when(F.col("n") > 0, F.col("block"))).alias("last"),
    )
    after = parts.join(groups.select("file", "grp", "last"), ["file", "grp"]).groupBy("file", "grp").agg(
        F.sum(F.when(F.col("last").isNull() | (F.col("block") >= F.col("last")), F.col("tail")).otherwise(0)).alias("tail")
    )
    above = _carried(groups.select("file", "grp", "n").join(after, ["file", "grp"]), ["file"], "grp").select(
        "file", "grp", F.col("docs").alias("docs_before"), F.col("carry").alias("carry_before")
    )
    joined = inside.join(above, ["file", "grp"])
    carry = F.col("carry") + F.when(F.col("bare"), F.col("carry_before")).otherwise(0)
    return joined.withColumn("docs", F.col("docs") + F.col("docs_before")).withColumn(
        "lengths",
        F.when(F.col("n") > 0, F.concat(F.array(F.col("head") + carry), F.col("inner").cast("array<long>"))).otherwise(F.array().cast("array<long>")),
    ).withColumn("open", F.when(F.col("n") > 0, F.col("tail")).otherwise(F.col("tail") + carry)).drop(
        "grp", "head", "inner", "tail", "seg", "carry", "bare", "docs_before", "carry_before"
    )


def documents_of(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """(file, position from 0, n_tokens, closed) of every document of flat token files."""
    scan = scanned(blocks.select("file", "block", "tokens"), separator, width)
    closed = scan.select("file", "docs", F.posexplode("lengths").alias("at", "n_tokens")).select(
        "file", (F.col("docs") + F.col("at")).alias("position"), "n_tokens", F.lit(True).alias("closed")
    )
    tails = scan.groupBy("file").agg(F.max_by("open", "block").alias("n_tokens"), F.sum("n").alias("position"))
    return closed.unionByName(tails.where("n_tokens > 0").select("file", "position", "n_tokens", F.lit(False).alias("closed")))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens, file, position) of every document, counted in the token files written from the table."""
    scan = scanned(written(docs, vocabulary, block_tokens))
    return scan.select("file", "docs", F.posexplode(F.arrays_zip("ends", "lengths")).alias("at", "one")).select(
        F.col("one.ends").alias("doc_id"), F.col("one.lengths").alias("n_tokens"), "file", (F.col("docs") + F.col("at")).alias("position")
    )
