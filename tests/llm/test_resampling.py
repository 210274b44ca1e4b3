import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from quotebridge.llm import queries, resampling

SCHEMA = "doc_id long, text string, score string, rank string, place string"


def features(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    runs = [" ".join(words[i:i + r]) for r in (1, 2, 3) for i in range(len(words) - r + 1)]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in runs]


def brute(docs, target, percent=5):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for _, text in target:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, words])
    eligible = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted(map(str, rows))


def corpus(count=400):
    draw = random.Random(9)
    rows = [(1, None), (2, ""), (3, "!!"), (None, "a b c " * 20), (5, "One"), (6, "one two"), (7, "é É漢_x9" * 30), (8, "x" * 9000)]
    rows += [(9, "same words here " * 9)] * 150 + [(10, "long " * 40_000)]
    for i in range(count):
        rows.append((100 + i, draw.choice([" ", "\n", "-"]).join(f"W{draw.randrange(60)}" for _ in range(draw.randrange(60)))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("margin", [2 / resampling.ACCURACY, 1e-9, 2.0])
def test_as_brute_force(spark, margin):
    docs, target = corpus(), [(i, f"w{i} w{i + 1} w{i * 7 % 60} same words") for i in range(40)] + [(None, None)]
    got = resampling.resampled(frame(spark, docs), frame(spark, target), percent=37, margin=margin).collect()
    assert sorted(str(list(r)) for r in got) == brute(docs, target, 37)


def test_query(spark, tmp_path):
    docs, target = corpus(), [(1, "w1 w2 w3 w4"), (2, "same")]
    frame(spark, docs).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, target).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op13_importance_resampling(spark, str(tmp_path)).collect()
    assert sorted(str(list(r)) for r in got) == brute(docs, target)


def test_bracket_is_proven_by_counts(spark):
    """A sketch that is off, here by a margin of nothing, is widened until the counts hold."""
    rows = spark.range(1000).selectExpr("id % 10 AS score")
    for k in (1, 99, 100, 101, 500, 1000):
        low, high, above = resampling.bracket(rows, 1000, k, 0.0 + 1e-12)
        want = sorted((i % 10 for i in range(1000)), reverse=True)[k - 1]
        assert low <= want <= high and above == sum(i % 10 > high for i in range(1000)) < k


def test_numbering_over_many_parts(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS score", "CAST(NULL AS LONG) AS doc_id", "1L AS n_features", "id AS place")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = resampling.numbered(rows.repartition(5), resampling.descending(), "test").orderBy("number").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["number"] for r in got] == list(range(5000))
    assert [(r["score"], r["place"]) for r in got] == sorted(((i % 7, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))


def test_pieces_of_a_long_text():
    text = " ".join(f"w{i}" for i in range(300)).encode()
    whole = Counter(b for part in resampling.feature_buckets(text) for b in part.tolist())
    cut = Counter()
    before = resampling.word_pieces
    try:
        resampling.word_pieces = lambda plain: before(plain, 5)
        cut.update(b for part in resampling.feature_buckets(text) for b in part.tolist())
    finally:
        resampling.word_pieces = before
    assert cut == whole == Counter(features(text.decode())[1])


def test_small_and_empty_tables(spark):
    empty = frame(spark, [])
    assert resampling.resampled(empty, empty).collect() == []
    docs = corpus(0)[:6]
    assert sorted(str(list(r)) for r in resampling.resampled(frame(spark, docs), empty).collect()) == brute(docs, [])
