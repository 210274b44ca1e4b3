import random

import xxhash

from quotebridge.llm import simhash

SCHEMA = "doc_id long, text string, fp string, label string"


def brute_print(text: str | None) -> int:
    blanks = " \t\n\v\f\r"
    words, word = [], ""
    for letter in text or "":
        letter = letter.lower() if "A" <= letter <= "Z" else letter
        if letter in blanks:
            words, word = words + [word] * bool(word), ""
        else:
            word += letter
    words += [word] * bool(word)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    return sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group)), key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in simhash.near_duplicates(df, **options).collect()), key=str)


def texts(count: int) -> list[tuple[int, str]]:
    draw = random.Random(5)
    base = [f"w{draw.randrange(4000)}" for _ in range(2500)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (5, "One two"), (5, "One two"), (7, "é É \v x" * 9), (8, "long " * 9000)]
    for i in range(count):
        copy = list(base)
        for _ in range(draw.randrange(3)):
            copy[draw.randrange(len(copy))] = f"v{draw.randrange(400)}"
        rows.append((100 + i, " ".join(copy)))
    return rows


def test_as_brute_force_with_short_and_with_crowded_lists(spark):
    rows = texts(60)
    want = brute(rows)
    assert len({r[2] for r in want}) < len(rows) - 20
    assert found(spark, rows) == want
    assert found(spark, rows, list_size=2) == want


def test_empty_table(spark):
    assert found(spark, []) == []


def test_one_of_each_component_stays(spark):
    rows = texts(40)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    firsts = [r[2] for r in brute(rows)]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(set(map(str, firsts)))


def test_one_row_stays_without_ids_and_with_repeated_ids(spark):
    """Rows without an id go where their component has a row with one; of rows without any id one stays; a repeated id with
    another text stays for its own component only."""
    rows = [(1, "a b c d"), (None, "a b c d"), (None, "a b c d"), (None, "other words stand here now"), (None, "other words stand here now"),
            (1, "quite another text with the same id"), (1, "quite another text with the same id"), (2, "quite another text with the same id")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, "a b c d"), (None, "other words stand here now"), (1, "quite another text with the same id")], key=str)
    assert simhash.keep_one(df.where("false")).collect() == []
