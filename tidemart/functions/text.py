"""Text column expressions: whitespace, tokens and n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is two or more letters, digits or underscores of any script.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def strip_all(value: Column) -> Column:
    """Strip every kind of leading and trailing whitespace, tabs and newlines included."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def is_blank(value: Column) -> Column:
    """True for null and for text without any non-whitespace character."""
    return value.isNull() | ~value.rlike(r"(?U)\S")


def collapse_newlines(value: Column) -> Column:
    return F.regexp_replace(value, r"[\n\r]+", " ")


def tokens(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(value), F.lit(TOKEN_PATTERN), 0)


def without(words: Column, stopwords: list[str]) -> Column:
    if not stopwords:
        return words
    return F.filter(words, lambda w: ~w.isin(stopwords))


def ngrams(words: Column, n: int) -> Column:
    """All contiguous n-word phrases, joined by one blank.

    Built by zipping the list with its own shifted tails, so every pass is linear; the
    shifted tails are shorter, which leaves null in the last places for `array_compact`.
    """
    phrases = words
    for shift in range(1, n):
        phrases = F.zip_with(
            phrases,
            F.slice(words, shift + 1, F.greatest(F.size(words), F.lit(0))),
            lambda head, nxt: F.concat(head, F.lit(" "), nxt),
        )
    return F.array_compact(phrases)
