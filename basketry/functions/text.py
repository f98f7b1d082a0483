"""Text measures and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.keys import ColumnOrName, _col


def tokens(text: ColumnOrName, lower: bool = False) -> Column:
    """White-space separated words; an empty text has none."""
    value = F.lower(_col(text)) if lower else _col(text)
    return F.filter(F.split(value, r"\s+"), lambda word: word != "")


def char_count(text: ColumnOrName) -> Column:
    return F.length(_col(text)).cast("bigint")


def word_count(text: ColumnOrName) -> Column:
    return F.size(tokens(text)).cast("bigint")


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring words, each joined by a space."""
    if n == 1:
        return words
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(words, i, n), " "),
    )
