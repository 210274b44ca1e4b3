"""The pipeline as a whole: each stage is its operator, applied to all that the stage before it has kept."""

import random

import pytest

import corpus_pipeline
from quotebridge.llm import decontamination, mixing, perplexity, sharding, simhash

#: Columns beyond those of the documents have the names that the stages use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept string, __id string, tokens string"
WORDS = "the of and river stone walks under evening light again house morning quiet window garden water road night".split()


def documents():
    draw = random.Random(12)

    def prose(n):
        return " ".join(draw.choice(WORDS) for _ in range(n))

    item = prose(40)  # plain words, so that only the benchmark stage can tell
    rows = [(i, prose(60), ["en", "de"][i % 2], f"s{i % 5}") for i in range(90)]
    rows += [(200 + i, rows[3][1], "en", "s1") for i in range(4)] + [(None, rows[3][1], "en", "s1"), (3, rows[3][1], "en", "s3")]
    rows += [(300, prose(30) + " " + item + " " + prose(30), "en", "s2"), (301, None, "en", "s1"), (302, "", None, None), (303, "too short", "en", "s1")]
    rows += [(304, prose(20_000), "en", "s0"), (None, prose(70), "de", None), (305, prose(60), None, "odd"), (305, prose(60), "en", "s4")]
    return [(i, t, lang, source, len(t or ""), "a", "b", "c", "d") for i, t, lang, source in rows], [(1, item), (2, None)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs, items = documents()
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows(df):
    return sorted(map(str, df.collect()))


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "benchmark_decontamination", "source_mixing", "shard_assignment"
    ]


def test_each_stage_is_its_operator_on_what_was_kept(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    operators = [
        perplexity.accepted, simhash.keep_one, lambda d: decontamination.clean(d, spark.read.parquet(f"{tables}/benchmark.parquet")),
        mixing.mixed, sharding.assigned,
    ]
    counts = [docs.count()]
    for position, ((name, stage), operator) in enumerate(zip(corpus_pipeline.STAGES, operators, strict=True)):
        path = f"{tmp_path}/{name}"
        stage(spark, docs, tables).write.parquet(path)
        after = spark.read.parquet(path)
        if position < 4:
            assert after.columns == columns
            assert rows(after) == rows(operator(docs))
            kept = rows(after)
            every = rows(docs)
            assert all(kept.count(r) <= every.count(r) for r in set(kept))  # rows go or stay, none is changed
        else:
            assert set(after.columns) >= {*columns, "virtual_slot"} and rows(after.drop("shard", "virtual_slot")) == rows(docs.drop("shard"))
        docs = after
        counts.append(after.count())
    assert counts == sorted(counts, reverse=True) and counts[4] > 20
    assert counts[1] > counts[2] > counts[3] > counts[4] == counts[5]


def test_decisions_take_effect(spark, tables):
    result = corpus_pipeline.run(spark, tables).collect()
    ids = [r["doc_id"] for r in result]
    assert not {300, 301, 302, 303, 200, 201, 202, 203} & set(ids)
    assert len({(r["doc_id"], r["text"]) for r in result}) == len(result)
    assert {r["shard"] for r in result} <= set(range(24))
    texts = [r["text"] for r in result]
    assert len(set(texts)) == len(texts)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
