import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from quotebridge.llm import lattice

SCHEMA = "doc_id long, text string, row string, words string"


def pieces():
    return lattice.Pieces(
        [lattice.MARK, lattice.MARK + b"a", lattice.MARK + b"ab", b"a", b"b", b"ab", b"ba", b"abb", b"c"] + [bytes([i]) for i in range(256)],
        [5, 4, 3, 2, 2, 3, 1, 1, 1] + [0.1] * 256, 2,
    )


def brute_word(own, word: bytes):
    """Sum over all segmentations, and the expected number of each piece."""
    text = lattice.MARK + word
    logs = dict(zip(own.names, own.logs, strict=True))
    total, expected = 0.0, Counter()
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(text[start:i])
                start = i
        parts.append(text[start:])
        if all(p in logs for p in parts):
            p = math.exp(sum(logs[x] for x in parts))
            total += p
            for x in parts:
                expected[x] += p
    return math.log(total), {k: v / total for k, v in expected.items()}


WORDS = [b"a", b"ab", b"abb", b"babab", b"abcabba", b"\xc3\xa9a", b"zzz"]


def test_marginals_as_enumeration():
    own = pieces()
    assert np.allclose(lattice.word_logs(own, WORDS), [brute_word(own, w)[0] for w in WORDS])


def test_expected_pieces_as_enumeration():
    own = pieces()
    counts = np.arange(1, len(WORDS) + 1)
    want = Counter()
    for word, n in zip(WORDS, counts, strict=True):
        for piece, expected in brute_word(own, word)[1].items():
            want[piece] += n * expected
    got = lattice.expected_pieces(own, WORDS, counts)
    assert np.allclose(got, [want.get(name, 0) for name in own.names])


@pytest.mark.parametrize("span", [1, 3, 1 << 16])
def test_words_alone_as_enumeration(monkeypatch, span):
    monkeypatch.setattr(lattice, "LONG", 0)
    monkeypatch.setattr(lattice, "SPAN", span)
    test_marginals_as_enumeration()
    test_expected_pieces_as_enumeration()


@pytest.mark.parametrize("span", [5, 64, 1000, 1 << 16])
def test_long_words_as_in_blocks(monkeypatch, span):
    own = lattice.read_pieces(lattice.VOCABULARY)
    rng = random.Random(3)
    words = [bytes(rng.choices(b"theandrsi", k=n)) for n in (1, 61, 62, 200, 900)] + ["é中𝄞".encode() * 40, bytes(range(33, 250))]
    counts = np.arange(1, len(words) + 1)
    monkeypatch.setattr(lattice, "LONG", 10**6)
    logs, expected = lattice.word_logs(own, words), lattice.expected_pieces(own, words, counts)
    monkeypatch.setattr(lattice, "LONG", 64)
    monkeypatch.setattr(lattice, "SPAN", span)
    assert np.allclose(lattice.word_logs(own, words), logs, rtol=1e-9)
    assert np.allclose(lattice.expected_pieces(own, words, counts), expected, rtol=1e-6, atol=1e-9)


def test_a_word_of_a_million_bytes():
    own = lattice.read_pieces(lattice.VOCABULARY)
    word = bytes(random.Random(5).choices(b"etaoinshrdlu", k=1_000_000))
    start = time.process_time()
    log, = lattice.word_logs(own, [word])
    assert time.process_time() - start < 60
    assert -20 * len(word) < log < 0


def test_probabilities_sum_to_one():
    own = pieces()
    assert abs(np.exp(own.logs).sum() + math.exp(own.end) - 1) < 1e-9


def words_of(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


@pytest.mark.parametrize("common", [5, 100_000])
def test_base_scores_and_counts_as_brute_force(spark, common):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["The", "the", "of", "x1", "ÉA", f"w{draw.randrange(60)}"]) for _ in range(draw.randrange(30))), "r", "w") for i in range(60)]
    rows += [(70, None, None, None), (71, "", None, None), (None, "the", None, None), (5, rows[5][1], "r", "w"), (72, "long " * 20_000, "r", "w"), (73, "q" * 3000, "r", "w")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r.doc_id, r.n_tokens): r for r in lattice.scored(df, common=common).collect()}
    count, ends = Counter(), 0
    for i, text, *_ in rows:
        if not out(i):
            count.update(words_of(text))
            ends += 1
    total, distinct = count.total() + ends, len(count) + 1
    seen = 0
    for i, text, *_ in rows:
        tokens = [*words_of(text), None]
        row = found[i, len(tokens)]
        c = [ends if t is None else count[t] for t in tokens]
        assert (row.held_out, row.train_tokens, row.n_known) == (out(i), total, sum(x > 0 for x in c))
        assert math.isclose(row.base_score, sum(math.log10((x + 1) / (total + distinct + 1)) for x in c), rel_tol=1e-9)
        assert row.score < 0 and math.isfinite(row.score)
        seen += row.held_out
    assert seen > 0


def test_rounds_raise_the_likelihood(spark):
    rows = [(i, "the river walks under the evening light again and again " * 3, "r", "w") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    totals = [sum(r.score for r in lattice.scored(df, rounds=n).collect()) for n in (0, 1, 2)]
    assert totals[0] < totals[1] < totals[2]


def test_empty_table(spark):
    assert lattice.scored(spark.createDataFrame([], SCHEMA)).collect() == []
