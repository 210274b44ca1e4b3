import random

import pytest

from quotebridge.llm import decontamination as D

SCHEMA = "doc_id long, text string, item_id string, edits string"


def brute_edits(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_least_edits_as_brute_force():
    draw = random.Random(1)
    for _ in range(300):
        item = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 90)))
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(0, 120)))
        edits, end = D.least_edits(item, text)
        assert edits == brute_edits(item, text) and 0 <= end <= len(text)


def test_pieces_cover_the_item():
    for n in range(1, 60):
        item = "".join(chr(97 + i % 26) for i in range(n))
        for budget in range(0, min(n, 6)):
            found = D.pieces(item, budget)
            assert "".join(p for _, p in found) == item and all(p and item.startswith(p, at) for at, p in found)
            assert len(found) == budget + 1


def edited(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = draw.randrange(len(letters))
        kind = draw.randrange(3)
        if kind == 0:
            letters[at] = draw.choice("xyz")
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, draw.choice("xyz"))
    return "".join(letters)


def tables(spark):
    draw = random.Random(6)

    def prose(n):
        return " ".join("".join(draw.choice("aeiournst") for _ in range(draw.randrange(1, 8))) for _ in range(n))

    items = [(i, prose(draw.randrange(6, 40))) for i in range(25)] + [(90, None), (91, " \n "), (92, "abc"), (3, "Repeated item of the benchmark"), (3, "Repeated item of the benchmark")]
    docs = [(1, None), (2, ""), (3, "abc"), (3, "abc"), (None, items[0][1])]
    for i in range(80):
        text = prose(draw.randrange(0, 60))
        if i % 2:
            item = items[draw.randrange(25)][1]
            text += " " + edited(draw, item, draw.randrange(0, 2 + len(item) // 9)) + "\n\t " + prose(5)
        docs.append((10 + i, text.upper() if i % 5 == 0 else text))
    docs.append((200, prose(4000) + " " + items[1][1] + " " + prose(4000) + " " + items[1][1][:-1]))
    return docs, items


@pytest.mark.parametrize("block_chars", [400, 2_000_000])
def test_as_brute_force(spark, block_chars):
    docs, items = tables(spark)
    want = []
    for i, text in docs:
        folded = D.folded((text or "").encode())
        for k, item in items:
            item = D.folded((item or "").encode())
            if item and len(folded) < 3000 and brute_edits(item, folded) <= int(D.ERROR_RATE * len(item)):
                want.append((i, k, brute_edits(item, folded)))
    want.append((200, 1, 0))
    df = spark.createDataFrame([(i, t, "x", None) for i, t in docs], SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.edits) for r in D.matches(df, benchmark, block_chars=block_chars).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) >= 30
    kept = D.clean(df, benchmark, block_chars=block_chars)
    assert kept.columns == df.columns
    dirty = {i for i, *_ in want}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in docs if i not in dirty), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text", "x", None)], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, items).collect() == [] and D.clean(docs, items).count() == 1
    some = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert D.matches(docs.where("false"), some).collect() == []
