"""Small string helpers shared by the supplier vocabularies."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(text: Column, fragments: list[str]) -> Column:
    """True when ``text`` holds at least one of the literal fragments."""
    return reduce(lambda a, b: a | b, [text.contains(f) for f in fragments])


def first_match(cases: list[tuple[Column, object]], default=None) -> Column:
    """Value of the first condition that holds, in list order."""
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def value_map(text: Column, mapping: dict[str, str]) -> Column:
    """Exact-value replacement; values outside the mapping stay as they are."""
    return first_match([(text == old, F.lit(new)) for old, new in mapping.items()], text)


def token(text: Column, separator: str, position: int) -> Column:
    """n-th token (0-based, or negative from the end); null when there is none."""
    parts = F.split(text, separator)
    if position >= 0:
        return F.get(parts, F.lit(position))
    return F.get(parts, F.size(parts) + F.lit(position))


def padded_words(text: Column, separators: str = "_+-.") -> Column:
    """Lower-case words with one space on each side, ready for ``has_word``."""
    spaced = F.translate(F.lower(text), separators, " " * len(separators))
    return F.concat(F.lit(" "), spaced, F.lit(" "))


def has_word(padded: Column, words: list[str]) -> Column:
    """True when one of the words occurs as a whole word of ``padded_words`` text."""
    return contains_any(padded, [f" {w} " for w in words])


def literal_array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])
