"""SentencePiece byte-pair encoding and decoding by a table of each prefix's last token.

A byte-pair model of this kind merges the neighbouring symbols whose joined piece has the best score, leftmost first. For a sequence
of tokens that result from their own letters, nothing is merged across a border of the whole sequence if and only if nothing
is merged across the border of any two neighbours alone: up to the first crossing, merges on the two sides don't see
each other. So every prefix of a text has one last token only, and a table holds it: an automaton lists the tokens
that end at a place, and the one that is compatible with the last token of the prefix before it is the one. The
identifiers are then recovered from the end backwards. Whether two tokens are compatible is told by replaying their
own merges side by side, in order of score, until a merge across the border comes first; the answers are remembered.

No piece holds a blank mark after another letter, or a line feed beside one, so texts are cut there and the results of the
cut-out words remembered (``MEMORY`` of them); models whose pieces don't allow the cut are encoded in whole texts.

Defined results: null and empty texts give the end identifier alone; letters that are no piece become the identifiers of
their bytes; repeated rows stay; an empty table gives no rows; ``encoded`` and ``decoded`` keep the columns they are told
to keep and read none but their own.
"""

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The end piece, and what an unknown piece is decoded to.
END, UNKNOWN_TEXT = "</s>", " \u2047 "
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The mark that stands for a blank in pieces.
BLANK = "▁"
#: Words, and as many token pairs, that a task remembers.
MEMORY = 500_000
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message in the wire format of model files."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at: at + size]
        at += size


def read_model(path: str) -> "Pieces":
    """(piece, score, kind) by identifier, the size of a vocabulary. Models with rules that this encoder lacks are refused."""
    with open(path, "rb") as file:
        fields = list(_fields(file.read()))
    pieces = []
    for _, value in (f for f in fields if f[0] == 1):
        one = dict(_fields(value))
        score = float(np.frombuffer(one.get(2, b"\0\0\0\0"), "<f4")[0])
        pieces.append((one.get(1, b"").decode(), score, one.get(3, NORMAL)))
    trainer = dict(next((_fields(v) for n, v in fields if n == 2), ()))
    rules = dict(next((_fields(v) for n, v in fields if n == 3), ()))
    plain = not rules.get(2) and rules.get(3, 1) and not rules.get(4, 1) and rules.get(5, 1) and not trainer.get(24, 0)
    if trainer.get(3, 1) != 2 or not plain or not {NORMAL, BYTE, CONTROL, UNKNOWN} >= {kind for _, _, kind in pieces}:
        raise ValueError(f"{path}: only byte-pair models with byte fallback, plain text and a blank in front are supported")
    return pieces


#: A rank that no merge has; a prefix whose last symbol merges with nothing: the empty one, or one that ends with a letter of no piece.
NEVER = float("inf")
SHIFT = 20
FREE = (1 << SHIFT) - 1


Pieces = list[tuple[str, float, int]]
#: A symbol's own merges in order: their ranks, its last symbol before and after each, its first symbol before and after each.
History = tuple[list[float], list[str], list[str]]


def ranks(pieces: Pieces) -> dict[str, float]:
    return {piece: -score for piece, score, kind in pieces if kind == NORMAL}


def history(symbol: str, rank: dict[str, float]) -> History | None:
    """The merges that a symbol's letters go through alone; None if they don't end in the symbol."""
    parts = list(symbol)
    done, lasts, firsts = [], [parts[-1]], [parts[0]]
    while len(parts) > 1:
        best, at = min((rank.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best == NEVER:
            return None
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
        done.append(best)
        lasts.append(parts[-1])
        firsts.append(parts[0])
    return [*done, NEVER], lasts, firsts


def histories(pieces: Pieces) -> dict[str, History]:
    """What can be the last symbol of a prefix: pieces that their letters give, and letters that only occur inside of pieces."""
    rank = ranks(pieces)
    symbols = set(rank) | {letter for piece in rank for letter in piece}
    return {s: found for s in sorted(symbols) if (found := history(s, rank))}


class Pairs(dict):
    """Whether two symbols (left << SHIFT | right) stay apart, found out when first asked for."""

    def __init__(self, pieces: Pieces, own: dict[str, History]):
        super().__init__()
        self.rank, self.own = ranks(pieces), list(own.values())

    def __missing__(self, key: int) -> bool:
        left, right = key >> SHIFT, key & FREE
        self[key] = found = left == FREE or self.compatible(self.own[left], self.own[right])
        return found

    def compatible(self, left: History, right: History) -> bool:
        """Their own merges go first until one across the border does."""
        own, lasts, _ = left
        other, _, firsts = right
        i = j = 0
        while True:
            across = self.rank.get(lasts[i] + firsts[j], NEVER)
            if across < own[i] and across <= other[j]:
                return False
            if own[i] == NEVER and other[j] == NEVER:
                return True
            if own[i] <= other[j]:
                i += 1
            else:
                j += 1


class Encoder:
    """Encodes texts with the pieces of a model; of one task, as it remembers what it has seen."""

    def __init__(self, pieces: Pieces, own: dict[str, History]):
        import ahocorasick

        identifier = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        self.end = np.int32(next(i for i, (piece, _, kind) in enumerate(pieces) if (piece, kind) == (END, CONTROL))).tobytes()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, symbol in enumerate(own):
            self.automaton.add_word(symbol, number)
        self.automaton.make_automaton()
        self.sizes = list(map(len, own))
        self.emitted = [
            np.array([identifier[s]] if s in identifier else [self.bytes[b] for b in s.encode()], np.int32).tobytes() for s in own
        ]
        self.pairs = Pairs(pieces, own)
        self.words: dict[str, bytes] = {}
        inner = re.compile(f"[^{BLANK}]{BLANK}|.\n|\n.", re.DOTALL)
        cuts = not any(inner.search(piece) for piece in identifier)
        self.cut = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n" if cuts else ".+", re.DOTALL).findall

    def tokens(self, word: str) -> bytes:
        """32-bit identifiers of a word, with blanks as marks."""
        number = self.automaton.get(word, None)
        if number is not None:
            return self.emitted[number]
        n = len(word)
        free = FREE << SHIFT
        table = [free] * (n + 1) if n < 10_000 else array("q", [free]) * (n + 1)  # last symbol by prefix length, shifted
        pairs, sizes = self.pairs, self.sizes
        if len(pairs) > MEMORY:
            pairs.clear()
        filled = -1
        for end, number in self.automaton.iter(word):
            if end != filled and pairs[table[end + 1 - sizes[number]] | number]:
                table[end + 1] = number << SHIFT
                filled = end
        found: list[bytes] = []
        at = n
        while at > 0:
            number = table[at] >> SHIFT
            if number == FREE:
                found += [np.int32(self.bytes[b]).tobytes() for b in reversed(word[at - 1].encode())]
                at -= 1
            else:
                found.append(self.emitted[number])
                at -= sizes[number]
        found.reverse()
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """32-bit identifiers of a text, the end identifier last."""
        words, parts = self.words, []
        for word in self.cut(BLANK + text.replace(" ", BLANK)) if text else ():
            found = words.get(word)
            if found is None:
                found = self.tokens(word)
                if len(word) < 64:
                    if len(words) >= MEMORY:
                        words.clear()
                    words[word] = found
            parts.append(found)
        parts.append(self.end)
        return b"".join(parts)


class Decoder:
    def __init__(self, pieces: Pieces):
        said = {UNKNOWN: lambda p: UNKNOWN_TEXT, CONTROL: lambda p: "", NORMAL: lambda p: p.replace(BLANK, " ")}
        self.said = [bytes([int(p[3:5], 16)]) if kind == BYTE else said[kind](p).encode() for p, _, kind in pieces]
        self.plain = np.array([kind == NORMAL for _, _, kind in pieces])
        self.control = np.array([kind == CONTROL for _, _, kind in pieces])

    def decode(self, ids: np.ndarray) -> str:
        """The text of identifiers: one blank at its beginning is the one that encoding put there; broken bytes become U+FFFD each."""
        ends = np.flatnonzero(self.control[ids]).tolist()  # bytes on the two sides of a control piece don't join
        parts = [ids[a:b] for a, b in zip([0, *(e + 1 for e in ends)], [*ends, len(ids)], strict=True)]
        texts = [b"".join(map(self.said.__getitem__, part.tolist())) for part in parts]
        first = next((i for i, part in enumerate(parts) if len(part)), None)
        if first is not None and texts[first][:1] == b" " and self.plain[parts[first][0]]:
            texts[first] = texts[first][1:]
        return "".join(text.decode(errors="broken-bytes") for text in texts)


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def encoded(docs: DataFrame, keep: list[str], text: str = "text", model: str = MODEL) -> DataFrame:
    """The kept columns and ``ids`` (array<int>) of each row's text, the end identifier last."""
    pieces = read_model(model)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, histories(pieces)))
    schema = docs.select(*keep).withColumn("ids", F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                found = [encoder.encode(t or "") for t in part[text].to_pylist()]
                ends = np.cumsum([0, *map(len, found)]) // 4
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.record_batch([*(part[c] for c in keep), ids], names=[*keep, "ids"])

    return docs.select(*keep, *([] if text in keep else [text])).mapInArrow(run, schema)


def decoded(rows: DataFrame, keep: list[str], ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The kept columns and ``decoded`` (text) of each row's identifiers; null counts as none."""
    pieces = rows.sparkSession.sparkContext.broadcast(read_model(model))
    schema = rows.select(*keep).withColumn("decoded", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import codecs

        codecs.register_error("broken-bytes", _each_byte)
        decoder = Decoder(pieces.value)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                none = np.empty(0, np.int32)
                texts = [
                    decoder.decode(one.values.to_numpy() if one.is_valid else none)
                    for one in part[ids].cast(pa.list_(pa.int32()))
                ]
                yield pa.record_batch([*(part[c] for c in keep), pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return rows.select(*keep, *([] if ids in keep else [ids])).mapInArrow(run, schema)
