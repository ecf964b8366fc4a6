"""Benchmark decontamination by winnowing, as DataFrame expressions only.

A benchmark window is ``WINDOW`` consecutive words. Both sides are cut into ``GRAM``-word hashes, of which the smallest
in every run of ``WINDOW - GRAM + 1`` is kept (the rightmost among equals). Two texts that share a whole window share such a run, so
they keep a common fingerprint: a join on fingerprints finds every candidate. Candidates are then extended: all
windows of the two texts are compared as word sequences and each covered word is marked.

Items of fewer words than a window are matched as a whole: documents give all n-grams of the lengths that occur among
short items, and only of those.

All work is per distinct text, keyed by a 128-bit key, so copies cost nothing and repeated or null ids need no care.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm import common

WINDOW, GRAM = 10, 5

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A to Z become a to z, nothing else changes; ``lower`` is the same on pure ASCII and much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Words of a text, lower-cased; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: an expression inside a lambda would be computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def grams(w: Column, n: int) -> Column:
    """Hashes of all n-grams of a word array."""
    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return bound(hashed, lambda h: F.when(F.size(h) < n, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(F.lit(n), *[F.get(h, i + k) for k in range(n)]))))


def winnowed(w: Column) -> Column:
    """The distinct kept fingerprints of a word array with at least WINDOW words."""
    run = WINDOW - GRAM + 1
    return bound(grams(w, GRAM), lambda g: F.when(F.size(g) < run, F.array().cast("array<bigint>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(g) - run), lambda i: F.least(*[F.get(g, i + k) for k in range(run)])))))


def sequences(w: Column, n: Column) -> Column:
    """All runs of n consecutive words, joined by one space, which no word holds."""
    return F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.concat_ws(" ", F.slice(w, i, n))))


def text_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, n_hit, n_items, items_sha256) for every distinct text of ``docs`` in which a window of an item occurs."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("v")).where(
        F.size("v") > 0).distinct()
    item_prints = items.select("item_id", "v", F.explode(
        F.when(F.size("v") >= WINDOW, winnowed(F.col("v"))).otherwise(F.array(_whole(F.col("v"))))).alias("print"))
    # The lengths of short items: nine numbers at most.
    short = sorted(r.n for r in items.where(F.size("v") < WINDOW).select(F.size("v").alias("n")).distinct().collect())
    texts = docs.select(common.text_key(F.col("text")).alias("key"), words(F.col("text")).alias("w"))
    prints = bound(F.col("w"), lambda w: F.concat(winnowed(w), *[F.array_distinct(grams(w, n)) for n in short]))
    doc_prints = texts.select("key", F.explode(prints).alias("print"))
    pairs = doc_prints.join(item_prints.select("item_id", "print"), "print").select("key", "item_id").distinct()
    per_text = pairs.join(items, "item_id")  # an id with several texts gives a row for each
    # One row for each distinct text that has a candidate; the smallest id stands for its copies.
    rows = docs.select("doc_id", common.text_key(F.col("text")).alias("key"))
    one = rows.join(pairs.select("key").distinct(), "key").groupBy("key").agg(F.min("doc_id").alias("first_id")).select(F.col("key").alias("one_key"), "first_id")
    full = docs.select("doc_id", "text", common.text_key(F.col("text")).alias("key"))
    full = full.join(one, (F.col("key") == F.col("one_key")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    candidates = full.select("key", words(F.col("text")).alias("w")).dropDuplicates(["key"])
    n = F.least(F.lit(WINDOW), F.size("v"))
    found = candidates.join(per_text, "key").select("key", "item_id", F.size("w").alias("n_words"), n.alias("n"), _starts(n).alias("starts"))
    hit = found.where(F.size("starts") > 0)
    covered = F.array_distinct(F.flatten(F.collect_list(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("n") - 1))))))
    return hit.groupBy("key").agg(
        F.size(covered).cast("long").alias("n_hit"), F.countDistinct("item_id").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.collect_set("item_id")), ","), 256).alias("items_sha256"))


def _whole(v: Column) -> Column:
    """The n-gram hash of a short item, as ``grams`` gives it for its own length."""
    out = F.lit(None).cast("long")
    for n in range(1, WINDOW):
        out = F.when(F.size(v) == n, F.get(grams(v, n), F.lit(0))).otherwise(out)
    return out


def _starts(n: Column) -> Column:
    """1-based places in w at which a run of n words of v starts."""
    return bound(sequences(F.col("v"), n), lambda known: bound(sequences(F.col("w"), n), lambda own: F.filter(
        F.transform(own, lambda x, i: F.when(F.array_contains(known, x), i + 1)), lambda s: s.isNotNull())))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    n_hit counts the words that any occurrence of an item window covers, n_items the items with an occurrence,
    items_sha256 is the digest of their ids, sorted as strings and joined by commas. Null texts have no words; items
    without words match nothing; a null item id is left out. Repeated rows, and rows of equal text, get equal results.
    Empty tables and further columns are fine.
    """
    hits = text_hits(docs, benchmark.where("item_id is not null"))
    rows = docs.select("doc_id", common.text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    count = F.coalesce("n_hit", F.lit(0))
    return rows.join(hits, "key", "left").select(
        "doc_id", "n_words", count.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (count > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` without an item window; all columns as they were."""
    hits = text_hits(docs, benchmark.where("item_id is not null")).select("key")
    return docs.join(hits, common.text_key(docs["text"]) == hits["key"], "left_anti")
