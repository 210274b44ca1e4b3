import random

import numpy as np
import pytest

from quotebridge.llm import token_scan as S

SCHEMA = "doc_id long, text string, file string, block string"


def test_counts_as_the_tokenizer(spark, monkeypatch):
    encode = S.encoder(S.read_ranks(S.VOCABULARY)).encode_ordinary
    rows = [(1, None), (2, ""), (3, "One two  three\n"), (3, "One two  three\n"), (None, "é ß 漢字 <|endoftext|>"), (6, "x" * 40_000), (7, "many words " * 5000)]
    rows += [(10 + i, "word " * (i % 23)) for i in range(300)]
    df = spark.createDataFrame([(i, t, "f", "b") for i, t in rows], SCHEMA).repartition(3)
    want = sorted(((i, len(encode(t or ""))) for i, t in rows), key=str)
    for block_tokens in (7, 1 << 18):
        monkeypatch.setattr(S, "GROUP_BLOCKS", 5)
        got = S.token_counts(df, block_tokens=block_tokens).collect()
        assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == want
        for file in {r.file for r in got}:
            places = sorted(r.position for r in got if r.file == file)
            assert places == list(range(len(places)))


def brute(stream, separator):
    found, length = [], 0
    for token in stream:
        if token == separator:
            found.append((len(found), length, True))
            length = 0
        else:
            length += 1
    return found + ([(len(found), length, False)] if length else [])


@pytest.mark.parametrize("block_tokens", [1, 3, 64, 100_000])
def test_flat_files(spark, tmp_path, block_tokens):
    draw = random.Random(block_tokens)
    want = []
    for name, rate in (("a.bin", 0.2), ("b.bin", 0.001), ("c.bin", 1.0), ("d.bin", 0.0)):
        stream = [9 if draw.random() < rate else draw.randrange(9) for _ in range(draw.randrange(200, 900))]
        np.array(stream, "<u2").tofile(tmp_path / name)
        want += [(name, *x) for x in brute(stream, 9)]
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "odd.bin").write_bytes(b"\x01\x00\x09\x00\x01")
    want += [("odd.bin", 0, 1, True)]
    blocks = S.flat_blocks(spark, str(tmp_path), 2, block_tokens)
    got = [(r.file.rsplit("/", 1)[1], r.position, r.n_tokens, r.closed) for r in S.documents_of(blocks, 9, 2).collect()]
    assert sorted(got) == sorted(want)


def test_empty_table(spark):
    assert S.token_counts(spark.createDataFrame([], SCHEMA)).collect() == []
