import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotebridge.llm import perplexity

SCHEMA = "doc_id long, text string, lang string, loss string, row string"


def brute_base(text: str | None):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


TEXTS = [
    None, "", " \n\t ", "one two", "é ß 漢字 𝒳 # * $ %", "a b c d e " * 4, "x\ny\nx\n\n \n x\nx", "a b c d e f g a b c d e h i j k l m n o p q r s t u v w x y z",
    "a\vb\fc\rd", "same same same same same same same same same same", "line one\r\nline one\r\nline one", "w" * 50_000, "a b c d " * 3000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_metrics_as_brute_force(text):
    assert perplexity.base_metrics((text or "").encode())[:6] == brute_base(text)


def test_base_metrics_of_random_texts():
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choice(["a ", "b ", "c\n", "d\t", "é ", "#| "]) for _ in range(draw.randrange(60)))
        assert perplexity.base_metrics(text.encode())[:6] == brute_base(text)


def brute_model(texts: list[str], order: int = 4):
    """Interpolated modified Kneser-Ney over UTF-16 units, by dictionaries."""
    counts: dict[int, Counter] = {order: Counter()}
    for text in texts:
        units = perplexity.units(text.encode()).tolist()
        counts[order].update(tuple(units[i:i + order]) for i in range(len(units) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts = {}
    for k in counts:
        n = [0] + [sum(v == i for v in counts[k].values()) for i in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        for i in (1, 2, 3):
            value = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0.5 * i
            cuts[k, i] = max(0.05, min(i - 0.05, value))

    def cut(k, n):
        return cuts[k, min(n, 3)]

    totals, weights = defaultdict(int), defaultdict(float)
    for k, grams in counts.items():
        for gram, n in grams.items():
            totals[k, gram[:-1]] += n
            weights[k, gram[:-1]] += cut(k, n)

    def probability(gram):
        k = len(gram)
        if not k:
            return 2.0 ** -16
        below = probability(gram[1:])
        total = totals.get((k, gram[:-1]))
        if not total:
            return below
        n = counts[k].get(gram, 0)
        return (n - cut(k, n) if n else 0) / total + weights[k, gram[:-1]] / total * below

    return probability


def corpus(count: int = 40):
    draw = random.Random(4)
    return ["".join(draw.choice("aab bcd éx𝒳") for _ in range(draw.randrange(5, 90))) for _ in range(count)]


def test_model_as_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    arrays = perplexity.sorted_arrays(perplexity.gram_counts(df))
    probability = brute_model(texts)
    for text in [*texts[:10], "abzzq new 漢 text", "𝒳𝒳𝒳𝒳"]:
        units = perplexity.units(text.encode()).tolist()
        want = [math.log(probability(tuple(units[i:i + 4]))) for i in range(len(units) - 3)]
        got = perplexity.log_probabilities(arrays, "en", perplexity.grams(np.array(units, np.uint16)))
        assert np.allclose(got, want, rtol=1e-4)


def test_small_arrays_keep_the_most_frequent(spark):
    df = spark.createDataFrame([(1, t, "en") for t in corpus()], "doc_id long, text string, lang string")
    arrays = perplexity.sorted_arrays(perplexity.gram_counts(df), rows=60)
    assert all(len(keys) <= 60 and (np.diff(keys.astype(object)) > 0).all() for keys, _ in arrays.values())
    assert len(arrays["en", "p", 4][0]) > 0


def prose(draw, n):
    return " ".join(draw.choice(["the", "of", "and", "river", "stone", "walks", "under", "evening", "light", "again"]) for _ in range(n))


def rows():
    draw = random.Random(8)
    found = [(i, prose(draw, 80), ["en", "de"][i % 2], None, "r") for i in range(120)]
    found += [(200, " ".join(w + "***" for w in prose(draw, 80).split()), "en", None, "r"), (201, " | ".join(f"x{draw.randrange(9**9)}" for _ in range(80)), "de", "z", "r")]
    return found + [(300, None, "en", None, None), (301, "", None, None, None), (302, "short", "xx", None, None), (None, prose(draw, 80), "en", None, "r"), (5, found[5][1], "de", None, "r")]


def test_verdicts(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    found = perplexity.verdicts(df).collect()
    assert len(found) == len(rows())
    assert {r.doc_id for r in found if not r.kept} == {200, 201, 300, 301, 302}
    assert all(r.lower <= r.loss <= r.upper for r in found if r.kept)
    kept = perplexity.accepted(df)
    assert kept.columns == df.columns and kept.count() == len(rows()) - 5


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert perplexity.verdicts(df).collect() == [] and perplexity.accepted(df).collect() == []


@pytest.mark.parametrize("rows", [0, 60, 10_000])
def test_losses_do_not_depend_on_what_is_broadcast(spark, monkeypatch, rows):
    monkeypatch.setattr(perplexity, "REST", 16)
    texts = {"en": corpus(30), "de": [t[::-1] for t in corpus(12)], "rare": ["zebra xylophone 漢字 quartz"]}
    models = {lang: brute_model(own + own[:lang == "en"]) for lang, own in texts.items()}
    docs = [(i, t, lang) for lang, own in texts.items() for i, t in enumerate(own)]
    df = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string, lang string")
    found = perplexity.verdicts(df, rows).collect()
    assert len(found) == len(docs) + 1
    got = {(r.doc_id, r.lang): r.loss for r in found}
    for i, text, lang in docs:
        units = perplexity.units(text.encode()).tolist()
        total = -sum(math.log(models[lang](tuple(units[k:k + 4]))) for k in range(len(units) - 3))
        words = max(1, len(re.sub(r"[!-/:-@\[-`{-~]", "", text).split()))
        assert math.isclose(got[i, lang], total / words, rel_tol=1e-4)


@pytest.mark.parametrize("rows", [0, 10_000])
def test_language_whose_grams_all_repeat(spark, rows):
    """No gram occurs once or twice: the discounts then have their defaults, as in the brute-force model."""
    docs = [(1, "a" * 40, "xx"), (2, "a" * 40, "xx"), (3, "b", "yy"), (4, "plain words of another tongue", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r.doc_id: r.loss for r in perplexity.verdicts(df, rows).collect()}
    probability = brute_model(["a" * 40, "a" * 40])
    units = perplexity.units(("a" * 40).encode()).tolist()
    want = -sum(math.log(probability(tuple(units[k:k + 4]))) for k in range(len(units) - 3))
    assert math.isclose(got[1], want, rel_tol=1e-4) and got[1] == got[2] and set(got) == {1, 2, 3, 4}
    assert perplexity.accepted(df, rows).collect() == []


def test_medians_are_exact_on_the_grid(spark):
    draw = random.Random(6)
    values = [(draw.choice("ab"), draw.random() * 3) for _ in range(501)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(values, "lang string, x double")
    for row in perplexity.medians(df, F.col("x"), "m").collect():
        own = sorted(round(x, 3) for lang, x in values if lang == row.lang)
        assert math.isclose(row.m, (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2, abs_tol=1e-9)
