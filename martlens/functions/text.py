"""Text helpers that stay inside the JVM (no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default opinion words, by polarity.
POSITIVE_WORDS = (
    "amazing", "best", "comfortable", "durable", "excellent", "fantastic", "good", "great",
    "happy", "impressed", "love", "loved", "perfect", "recommend", "reliable", "sturdy", "superb", "warm",
)
NEGATIVE_WORDS = (
    "awful", "bad", "broke", "broken", "cheap", "defective", "disappointed", "disappointing", "faulty",
    "hate", "leaked", "poor", "refund", "returned", "terrible", "tore", "worst", "uncomfortable",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters of the whole text; the first and last piece may be empty."""
    return F.split(F.lower(_col(text)), r"[^\p{L}]+")


def sentences(text: Column | str) -> Column:
    """Trimmed, non-empty pieces between sentence ends and line breaks."""
    parts = F.transform(F.split(_col(text), r"[.!?\n]+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != F.lit(""))


def count_in(token_array: Column, words: Sequence[str]) -> Column:
    """How many tokens belong to ``words``."""
    return F.size(F.filter(token_array, lambda t: t.isin(*words)))


def mentions(sentence: Column, words: Sequence[str]) -> Column:
    """True when a sentence holds at least one of ``words`` as a whole token."""
    return F.exists(F.split(F.lower(sentence), r"[^\p{L}]+"), lambda t: t.isin(*words))
