import random

import numpy as np
import pytest

from quotebridge.llm import suffix_dedup

SCHEMA = "doc_id long, text string, words string"


def brute(rows) -> dict:
    """Words of each document that lie in a run of 50 words that another text holds too."""
    texts = {t: (t or "").split() for _, t in rows}
    seen: dict[tuple, set] = {}
    for t, words in texts.items():
        for i in range(len(words) - 49):
            seen.setdefault(tuple(words[i:i + 50]), set()).add(t)
    counts = {}
    for _, t in rows:
        counts[t] = counts.get(t, 0) + 1
    found = {}
    for i, t in rows:
        own = set()
        for k in range(len(texts[t]) - 49):
            if len(seen[tuple(texts[t][k:k + 50])]) > 1 or counts[t] > 1:
                own |= set(range(k, k + 50))
        if own:
            found[i] = own
    return found


def covered(df) -> dict:
    found: dict = {}
    for r in df.collect():
        assert r["words"] == r["end_word"] - r["start_word"] >= 50 and r["other_doc_id"] != r["doc_id"]
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    return found


def corpus():
    draw = random.Random(9)

    def prose(n):
        return [f"w{draw.randrange(3000)}" for _ in range(n)]

    passages = [prose(n) for n in (50, 51, 60, 85, 120, 400)]
    rows = [(1, None), (2, ""), (3, "short text"), (4, " ".join(["a"] * 3000)), (5, " ".join(["a"] * 45 + ["b"] * 300))]
    for i in range(60):
        words = prose(draw.randrange(0, 200))
        for _ in range(draw.randrange(0, 3)):
            words += passages[draw.randrange(len(passages))] + prose(draw.randrange(0, 90))
        rows.append((10 + i, " ".join(words)))
    base = prose(600)
    for i in range(30):
        words = list(base)
        for _ in range(draw.randrange(1, 6)):
            words[draw.randrange(600)] = f"v{draw.randrange(90)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200, rows[20][1]), (201, rows[20][1])]
    return rows


def test_as_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    want = brute(rows)
    got = covered(suffix_dedup.repeated_passages(df, inside=False))
    assert all(got[i] <= want[i] for i in got)
    assert got == want


def test_edges_of_sorted_partitions(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 40)
    monkeypatch.setattr(suffix_dedup, "MATES", 2)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = corpus()
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
        assert covered(suffix_dedup.repeated_passages(df, inside=False)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.repeated_passages(df).collect() == []


def test_minimisers_depend_on_content_alone():
    draw = np.random.default_rng(1)
    passage = draw.integers(1, 1 << 32, 300, dtype=np.uint32)
    own = suffix_dedup.minimisers(suffix_dedup.grams_of(passage[50:250]))
    whole = suffix_dedup.minimisers(suffix_dedup.grams_of(passage)) - 50
    assert set(own) <= set(whole.tolist())


def links(df, rows):
    """{(text, other text): words}, without copies, and the order of the texts."""
    order = {r["text"]: r["t"] for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS t").distinct().collect()}
    text_of = dict(rows)
    found: dict = {}
    for r in suffix_dedup.repeated_passages(df, inside=False).where("NOT copy").collect():
        pair = text_of[r["doc_id"]], text_of[r["other_doc_id"]]
        found.setdefault(pair, set()).update(range(r["start_word"], r["end_word"]))
    return found, order


@pytest.mark.parametrize("mates", [2, 16])
def test_all_holders_of_a_passage_meet_in_one_text(spark, monkeypatch, mates):
    monkeypatch.setattr(suffix_dedup, "MATES", mates)
    draw = random.Random(5)

    def prose(n):
        return " ".join(f"w{draw.randrange(3000)}" for _ in range(n))

    one, two, wide, wider = prose(55), prose(60), prose(30), prose(30)
    rows = corpus()
    rows += [(300, f"{prose(40)} {one} {prose(9)}"), (301, f"{prose(20)} {two}"), (302, f"{one} {two}")]
    for k, shared in enumerate((wide, wide, wider, wider)):
        rows.append((310 + k, f"{prose(10)} {shared} {two} {prose(10)}"))
    rows += [(320 + k, f"{prose_of} {one}") for k, prose_of in enumerate([prose(70)] * 2 + [prose(80)] * 2)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    found, order = links(df, rows)
    holders: dict = {}
    for text in order:
        words = (text or "").split()
        for i in range(len(words) - 49):
            holders.setdefault(tuple(words[i:i + 50]), {}).setdefault(text, []).append(i)
    may: dict = {}
    for own in (h for h in holders.values() if len(h) > 1):
        first = min(own, key=order.get)
        for text, starts in own.items():
            covered_by = [found.get((text, o), set()) for o in ([first] if text != first else own) if o != text]
            assert all(any(set(range(i, i + 50)) <= c for c in covered_by) for i in starts)
            for other in own:
                may.setdefault((text, other), set()).update(k for i in starts for k in range(i, i + 50))
    assert all(words <= may[pair] for pair, words in found.items())


def brute_places(rows):
    """{(text, word, least or greatest place's text, keeps)} of every passage of 50 words that stands in two places."""
    holders: dict = {}
    for text in {t for _, t in rows}:
        words = (text or "").split()
        for i in range(len(words) - 49):
            holders.setdefault(tuple(words[i:i + 50]), []).append((text, i))
    return [places for places in holders.values() if len(places) > 1]


@pytest.mark.parametrize(("mates", "light"), [(1, 0), (16, 100_000), (10**6, 0)])
def test_passages_inside_and_across_texts_as_brute_force(spark, monkeypatch, mates, light):
    """Least and greatest place of every passage, whatever the frequency of its grams and whatever is broadcast."""
    monkeypatch.setattr(suffix_dedup, "MATES", mates)
    monkeypatch.setattr(suffix_dedup, "LIGHT", light)
    draw = random.Random(2)

    def prose(n):
        return [f"w{draw.randrange(3000)}" for _ in range(n)]

    twice, other = prose(80), prose(55)
    rows = [(1, " ".join(twice + prose(30) + twice)), (2, " ".join(["a"] * 300)), (3, " ".join(prose(60) + other)), (4, " ".join(other * 3))]
    rows += [(10 + k, " ".join(prose(20) + twice + prose(k))) for k in range(5)] + [(20, rows[0][1]), (None, "x")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    order = {r["text"]: r["t"] for r in df.selectExpr("text", "xxhash64(coalesce(text, '')) AS t").distinct().collect()}
    want: dict = {}
    for places in brute_places(rows):
        places.sort(key=lambda p: (order[p[0]], p[1]))
        for place in places:
            keeps = place == places[0]
            key = place[0], (places[-1] if keeps else places[0])[0], keeps
            want.setdefault(key, set()).update(range(place[1], place[1] + 50))
    found = suffix_dedup.spans(suffix_dedup.matches(suffix_dedup.representatives(df, suffix_dedup.distinct_texts(df))))
    text_of = {t: text for text, t in order.items()}
    got: dict = {}
    for r in found.collect():
        got.setdefault((text_of[r["t"]], text_of[r["other"]], r["keeps"]), set()).update(range(r["start"], r["stop"]))
    assert got == want
    kept = {r["doc_id"] for r in suffix_dedup.repeated_passages(df).where("copy AND keeps").collect()}
    assert kept == {1}


def test_frequency_split_decides_cost_only(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = []
    for mates in (1, 16, 10**6):
        monkeypatch.setattr(suffix_dedup, "MATES", mates)
        found.append(sorted(map(str, suffix_dedup.repeated_passages(docs).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 100
