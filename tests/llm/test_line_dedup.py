import random
import zlib

import pytest

from quotebridge.llm import line_dedup

SCHEMA = "doc_id long, text string, lines string"


def words_of(line: str) -> frozenset[str]:
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    for blank in "\t\v\f\r":
        folded = folded.replace(blank, " ")
    return frozenset(w for w in folded.split(" ") if w)


def brute(rows):
    """The text that stays of each distinct (doc_id, text)."""
    docs = sorted({(i if i is not None else 1 << 62, t or "") for i, t in rows})
    lines = [(d, t, k, words_of(line)) for d, t in docs for k, line in enumerate(t.split("\n"))]
    stays = {}
    for a, (d, t, k, mine) in enumerate(lines):
        earlier = [o for o in lines[:a] if o[3]]
        if not mine or not any(9 * len(mine & o[3]) >= 4 * (len(mine) + len(o[3])) for o in earlier):
            stays.setdefault((d, t), []).append(t.split("\n")[k])
    return sorted(
        ((i, len((t or "").split("\n")), "\n".join(stays.get((i if i is not None else 1 << 62, t or ""), []))) for i, t in rows), key=str
    )


def corpus() -> list[tuple[int | None, str | None]]:
    draw = random.Random(3)
    pool = [f"w{int(draw.paretovariate(0.7)) % 300}" for _ in range(400)]
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "A b c d\na B c d\nd c b a e\n"), (4, "A b c d\na B c d\nd c b a e\n"), (None, "a b c d e f"), (6, "long " * 3000)]
    template = [draw.choice(pool) for _ in range(40)]
    for i in range(60):
        lines = []
        for _ in range(draw.randrange(1, 5)):
            if draw.random() < 0.5:
                line = list(template)
                for _ in range(draw.randrange(0, 9)):
                    line[draw.randrange(len(line))] = f"x{draw.randrange(900)}"
            else:
                line = [draw.choice(pool) for _ in range(draw.randrange(1, 12))]
            lines.append(" ".join(line))
        rows.append((10 + i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize(("size", "width"), [(1, 2), (5, 32), (128, 32)])
def test_as_brute_force(spark, size, width):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["n_lines"], r["text"]) for r in line_dedup.deduplicated(df, size, width).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_report_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b\nb a\nc", "z")], SCHEMA)
    row = line_dedup.report(df).first()
    assert tuple(row) == (1, 3, 1, 5, zlib.crc32(b"a b\nc"))
    assert line_dedup.report(df.where("false")).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b c d e\nb a", "z")], SCHEMA)
    plan = line_dedup.classes(line_dedup.rows_of(df), line_dedup.rarity(line_dedup.rows_of(df)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lines_of_common_words_only(spark):
    """Every word is in many lines, so all lists are long and pairs are only found by the rounds over them."""
    draw = random.Random(8)
    pool = [f"c{i}" for i in range(40)]
    base = [draw.sample(pool, 12) for _ in range(120)]
    rows = [(i, "\n".join(" ".join(draw.choice(base) if draw.random() < 0.4 else draw.sample(pool, 12)) for _ in range(3))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["n_lines"], r["text"]) for r in line_dedup.deduplicated(df, 4, 3).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_intermediate_tables_are_deleted(spark):
    from pathlib import Path

    from quotebridge.sinks.staging import shared_folder

    folder = Path(shared_folder(spark))
    before = {f.name for f in folder.iterdir()}
    df = spark.createDataFrame([(i, t, "z") for i, t in corpus()], SCHEMA)
    line_dedup.report(df, 5, 4).collect()
    assert {f.name.rsplit("-", 1)[0] for f in folder.iterdir() if f.name not in before} <= {"kept-lines"}


def test_shuffle_files_are_deleted(spark):
    import time

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def shuffles() -> set[str]:
        files = env.blockManager().diskBlockManager().getAllFiles().iterator()
        found = set()
        while files.hasNext():
            found.add(files.next().getName())
        return {name for name in found if name.startswith("shuffle_") and name.endswith(".data")}

    df = spark.createDataFrame([(i, t, "z") for i, t in corpus()], SCHEMA)
    before = shuffles()
    line_dedup.kept_lines(df)
    for _ in range(20):
        if not shuffles() - before:
            break
        time.sleep(0.5)
    assert not shuffles() - before


def test_lines_of_many_words(spark):
    """Parities of 64 and of 128 bits, on both sides of their border, at and around the similarity that counts."""
    draw = random.Random(12)
    rows = []
    for i, n in enumerate([52, 58, 60, 61, 66, 75, 150, 300]):
        base = [f"b{i}x{k}" for k in range(n)]
        lines = [base]
        for part in (0.1, 0.11, 0.112, 0.13, 0.2):
            own = draw.sample(base, n - round(part * n))
            lines += [own, own + [f"c{draw.randrange(10**6)}" for _ in range(n - len(own))]]
        draw.shuffle(lines)
        rows += [(100 * i + k, " ".join(line)) for k, line in enumerate(lines)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["n_lines"], r["text"]) for r in line_dedup.deduplicated(df).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_rarity_counts_every_text(spark):
    """Words that are in one text only count, whichever text it is: a word's cell has the level of its number of places."""
    from math import floor, log2

    from pyspark.sql import functions as F

    times = {f"only{i}": 1 + i % 5 for i in range(40)}
    df = spark.createDataFrame([(i, "\n".join([word] * n), "z") for i, (word, n) in enumerate(times.items())], SCHEMA)
    levels = line_dedup.rarity(line_dedup.rows_of(df))
    found = spark.createDataFrame([(w,) for w in times], "w string").select(
        "w", F.ascii(F.substring(levels, line_dedup.cell(F.xxhash64("w")) + 1, 1).cast("string")).alias("level")
    )
    assert {r.w: r.level for r in found.collect()} == {w: floor(log2(n + 1) * 4) for w, n in times.items()}
