"""Benchmark decontamination by pigeonhole edit matching.

Texts are folded (A to Z in lower case, each run of blanks one space). An item of n letters may be found with up to
k = floor(``ERROR_RATE`` x n) edits (letters put in, left out or changed). Cut into k + 1 pieces, at least one piece
occurs unchanged in every such place, so an automaton over all pieces finds the candidates, and Myers' bit-parallel distance
verifies the neighbourhood of each hit. Nothing within the budget is missed.

Items are a query set against all documents and are taken in blocks of about ``BLOCK_CHARS`` letters, each a pass over
the documents, so the automaton's size is bounded whatever the size of the benchmark.

Defined results: null and blank items match nothing, null texts match nothing; repeated items and repeated documents each
give their own rows; an item shorter than 1/``ERROR_RATE`` letters is matched exactly; empty tables give no matches; only doc_id,
item_id and text are read by ``matches``; ``clean`` keeps all columns of the documents.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebridge.llm.common import raw_texts, tidy

ERROR_RATE = 0.07
BLOCK_CHARS = 2_000_000


def folded(text: bytes) -> str:
    return b" ".join(text.lower().split()).decode("utf-8", "replace")


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item in budget + 1 nearly equal pieces with their offsets."""
    count = budget + 1
    cuts = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def least_edits(item: str, text: str) -> tuple[int, int]:
    """(edits, end) of the best place of ``item`` in ``text``: least edits, then the earliest end."""
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    rows: dict[str, int] = {}
    for i, letter in enumerate(item):
        rows[letter] = rows.get(letter, 0) | 1 << i
    up, down, edits = full, 0, size
    best, end = size, 0
    for i, letter in enumerate(text, 1):
        equal = rows.get(letter, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        grows, shrinks = down | ~(diagonal | up) & full, up & diagonal
        if grows & top:
            edits += 1
        elif shrinks & top:
            edits -= 1
            if edits < best:
                best, end = edits, i
                if not best:
                    break
        grows, shrinks = grows << 1 & full, shrinks << 1 & full
        vertical = equal | down
        up, down = shrinks | ~(vertical | grows) & full, grows & vertical
    return best, end


class Matcher:
    """Finds the items of a block in folded texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, item, int(rate * len(item))) for i, item in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for at, (_, item, budget) in enumerate(self.items):
            for offset, piece in pieces(item, budget):
                places.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def found(self, text: str, first_only: bool = False) -> list[tuple[int, int, int]]:
        """(place of the item, edits, end in the folded text) of each item within its budget."""
        if self.empty:
            return []
        starts: dict[int, set[int]] = {}
        for last, (length, found) in self.automaton.iter(text):
            for at, offset in found:
                starts.setdefault(at, set()).add(last + 1 - length - offset)
        result = []
        for at, own in starts.items():
            _, item, budget = self.items[at]
            best = None
            reached = -1
            ordered = sorted(own)
            for k, start in enumerate(ordered):
                if k and start - budget <= reached:
                    continue
                stop = start
                for later in ordered[k:]:  # neighbouring hits share a window
                    if later > stop + len(item):
                        break
                    stop = later
                low, reached = max(0, start - budget), stop
                edits, end = least_edits(item, text[low: stop + len(item) + budget])
                if edits <= budget and (best is None or edits < best[0]):
                    best = (edits, low + end)
                    if not edits:
                        break
            if best:
                result.append((at, *best))
                if first_only:
                    break
        return result


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Blocks of (item_id, folded text); each is bounded, the number of blocks grows with the benchmark."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    letters = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-letters // block_chars))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield [(r["item_id"], item) for r in rows if (item := folded(r["text"].encode()))]


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, budget, end) of every item that a document holds; end: after the best place, in the folded text."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    results = []
    for items in item_blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows = []
                for i, text in enumerate(raw_texts(batch["text"])):
                    rows += [(i, *m) for m in matcher.found(folded(text))]
                ids = batch["doc_id"].take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.record_batch({
                    "doc_id": ids,
                    "item_id": pa.array([matcher.items[r[1]][0] for r in rows], pa.int64()),
                    "edits": pa.array([r[2] for r in rows], pa.int64()),
                    "budget": pa.array([matcher.items[r[1]][2] for r in rows], pa.int64()),
                    "end": pa.array([r[3] for r in rows], pa.int64()),
                })

        results.append(texts.mapInArrow(tidy(run), "doc_id long, item_id long, edits long, budget long, end long"))
    found = results[0]
    for other in results[1:]:
        found = found.unionAll(other)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no item of the benchmark, with all their columns."""
    for items in item_blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                free = [not matcher.found(folded(text), first_only=True) for text in raw_texts(batch["text"])]
                yield batch.filter(pa.array(free, pa.bool_()))

        docs = docs.mapInArrow(tidy(run), docs.schema)
    return docs
