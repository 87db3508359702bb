"""Small helpers to build column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Higher-order functions are outside Spark's common-subexpression elimination, so an expensive array that feeds
    several of them would otherwise be computed once for each.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when at least one word is a substring of ``text``."""
    found = text.contains(words[0])
    for word in words[1:]:
        found = found | text.contains(word)
    return found


def count_contained(text: Column, words: list[str]) -> Column:
    """How many of the words are substrings of ``text``."""
    hits = F.lit(0)
    for word in words:
        hits = hits + text.contains(word).cast("int")
    return hits


def array_of(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])
