import codecs
import hashlib
import random

import numpy as np
import pytest

from quotebridge.llm import piece_encoding, queries

sentencepiece = pytest.importorskip("sentencepiece")
SCHEMA = "doc_id long, text string, ids string, decoded string"
codecs.register_error("broken-bytes", piece_encoding._each_byte)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_encoding.MODEL)


@pytest.fixture(scope="module")
def pieces():
    return piece_encoding.read_model(piece_encoding.MODEL)


def texts(pieces, count=3000):
    draw = random.Random(1)
    letters = list("ab \n\r\t;){▁é漢😀\x00\xa0=-*") + ["the", "ing", "   ", "<0x0A>", "</s>", "';\r"]
    normal = [p for p, _, kind in pieces if kind == piece_encoding.NORMAL]
    rows = ["", " ", "  ", "a", "▁", "\n", "漢" * 50, "x" * 20_000, "the" * 9000]
    rows += [" " * k for k in range(70)] + ["a" * k for k in range(90)] + ["=-" * k + "=" * k for k in range(40)]
    for source in (letters, normal):
        rows += ["".join(draw.choice(source) for _ in range(draw.randrange(50))) for _ in range(count)]
    return rows


def test_as_the_library(pieces, library):
    encoder = piece_encoding.Encoder(pieces, piece_encoding.histories(pieces))
    decoder = piece_encoding.Decoder(pieces)
    for text in texts(pieces):
        ids = np.frombuffer(encoder.encode(text), np.int32)
        assert ids.tolist() == library.encode(text, add_eos=True), repr(text)
        assert decoder.decode(ids) == library.decode(ids.tolist())


def test_any_ids_decode_as_the_library(pieces, library):
    draw = random.Random(2)
    decoder = piece_encoding.Decoder(pieces)
    for _ in range(20_000):
        ids = [draw.choice([draw.randrange(3, 259), draw.randrange(300), draw.randrange(len(pieces))]) for _ in range(draw.randrange(9))]
        assert decoder.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_whole_texts_without_cuts(pieces, library):
    """A piece across a cut turns cutting off; small memories are emptied and filled again."""
    odd = [*pieces, ("x\ny", -40_000.0, piece_encoding.NORMAL)]
    encoder = piece_encoding.Encoder(odd, piece_encoding.histories(odd))
    assert encoder.cut("▁a b\nc") == ["▁a b\nc"]
    for text in texts(pieces, 200):
        if "x\ny" not in text:
            assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text, add_eos=True)


def test_small_memory(pieces, library, monkeypatch):
    monkeypatch.setattr(piece_encoding, "MEMORY", 3)
    encoder = piece_encoding.Encoder(pieces, piece_encoding.histories(pieces))
    for text in texts(pieces, 100):
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text, add_eos=True)


def test_query_on_odd_rows(spark, library, tmp_path):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "same"), (4, "same"), (5, "long word " * 9000), (6, "é\n漢")]
    spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        said = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
        want.append((i, len(ids), *said))
    got = [tuple(r) for r in queries.op12_piece_encoding(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_ids_and_texts_beside_other_columns(spark, library):
    df = spark.createDataFrame([(1, "a b", "own", "mine"), (2, None, None, None)], SCHEMA).drop("ids", "decoded")
    back = piece_encoding.decoded(piece_encoding.encoded(df, ["doc_id", "text"]), ["doc_id", "ids"])
    assert [(r["doc_id"], list(r["ids"]), r["decoded"]) for r in back.orderBy("doc_id").collect()] == [
        (1, library.encode("a b", add_eos=True), "a b"), (2, [2], "")
    ]
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert piece_encoding.decoded(nothing, ["doc_id"]).first()["decoded"] == ""


def test_empty_table(spark):
    assert piece_encoding.encoded(spark.createDataFrame([], SCHEMA), ["doc_id"]).collect() == []


def test_other_models_are_refused(tmp_path):
    def field(number, value):
        return bytes([number << 3 | 2, len(value)]) + value

    unigram = field(2, bytes([3 << 3, 1]))
    path = tmp_path / "other.model"
    path.write_bytes(field(1, field(1, b"a")) + unigram)
    with pytest.raises(ValueError):
        piece_encoding.read_model(str(path))
