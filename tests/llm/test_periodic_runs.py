import hashlib
import random
import re
import zlib

from quotebridge.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string, runs string, key string, block string"


def brute_runs(words):
    """Every stretch w[i] == w[i + q] by itself; a stretch that a shorter period has too is that period's."""
    found = {}
    n = len(words)
    for q in range(1, n):
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - i + q
            if end > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = max(end, i + 1) if end > i else i + 1
    return sorted((start, q, length) for (start, length), q in found.items())


def brute(doc_id, text, loop=False):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if loop and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for start, q, length in runs for i in range(start + q, start + length)}
    return n, [(s, length, q) for s, q, length in runs], " ".join(w for i, w in enumerate(words) if i not in gone)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


def texts():
    draw = random.Random(11)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (5, "a a a a a"), (5, "a a a a a"), (6, "x " * 700 + "y"),
            (7, "é É " * 40), (8, "a b " * 3 + "a"), (9, "one\x0btwo\x0cone\rtwo one two one two")]
    for i in range(300):
        letters = draw.choice(["ab", "abc", "abcdefgh"])
        words = [draw.choice(letters) for _ in range(draw.randrange(1, 90))]
        for _ in range(draw.randrange(4)):
            at, size = draw.randrange(len(words)), draw.randrange(1, 40)
            words[at:at] = words[at: at + size] * draw.randrange(1, 7)
        rows.append((100 + i, draw.choice([" ", "\n", "\t "]).join(words)))
    return rows


def test_runs_as_brute_force(spark):
    rows = texts()
    got = periodic_runs.periodic_runs(rows_of(spark, rows)).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["kept_text"]) for r in got))) == sorted(
        map(str, ((i, *brute(i, t)) for i, t in rows))
    )


def test_query_as_brute_force(spark, tmp_path):
    rows = texts()
    rows_of(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        _, runs, kept = brute(i, t, loop=True)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((
            i, len(runs), *top, top[1] * 1000 // top[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest(),
        ))
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert sorted(map(str, (tuple(r)[:8] for r in got.collect()))) == sorted(map(str, want))


def test_long_run_over_many_tiles(spark):
    draw = random.Random(3)
    word = [f"w{draw.randrange(10**6)}" for _ in range(4097)]
    text = " ".join(["start"] + word * 9 + word[:11] + ["end"])
    got = periodic_runs.periodic_runs(rows_of(spark, [(1, text)])).first()
    assert [tuple(r) for r in got["runs"]] == [(1, 9 * 4097 + 11, 4097)]
    assert got["kept_text"] == " ".join(["start", *word, "end"])


def test_words_cut_into_pieces(spark, monkeypatch):
    words = ["a", "bb"] * 30
    for size in (1, 7, 1 << 20):
        pieces = list(periodic_runs.word_pieces(" ".join(words).encode(), size))
        assert [w.decode() for piece in pieces for w in piece] == words


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(rows_of(spark, [])).collect() == []
