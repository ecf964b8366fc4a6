"""Long repeated word sequences by recompression.

A text is a string of word symbols. Rounds of recompression replace short runs of one symbol, and pairs whose left
symbol is of the "left" and whose right symbol is of the "right" half of the alphabet, by a new symbol. A new symbol's name is a hash
of what it stands for, so equal pieces get equal names on every executor without a dictionary being shuffled. Whether two neighbours
merge depends on them alone, so two occurrences of one word sequence have the same symbols inside; only a bounded
number of words at either end can differ (``rounds`` keeps that bound within the window).

For each window the symbol with the smallest hash in the common interior is its anchor. An anchor's key is the
hash of its symbol with the margin of words on both sides, which every window that chooses it holds. Equal windows thus have
anchors with equal keys:

1. one pass gives the anchors of every text (about one in twelve words); keys that occur once are dropped by counting;
2. texts with a remaining anchor give 128-bit hashes of the windows that chose one; windows that occur once are dropped;
3. what is left covers the words to remove.

Copies of a whole text are counted by their key and give windows once. Counts are reduced map-side, and joins are plain
equi joins, so a passage that a third of all texts share moves as one row per task when counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm import common
from martlens.llm.common import mix, slices, text_bytes, word_hashes, words_of

WINDOW = 35

_U = np.uint64
#: (kind, largest number of words of a new symbol)
STEPS = (("runs", 3), ("pairs", 4), ("pairs", 8), ("pairs", 16), ("pairs", 32))


def rounds(window: int) -> tuple[list[tuple[str, int]], int]:
    """The rounds after which every window still holds a whole common symbol, and the margin in words.

    A round of runs can differ in one short run at either end, a round of pairs in one symbol. The interior between the margins
    must hold a symbol wherever symbols begin, so it is at least twice the symbol size, less one word.
    """
    chosen, margin, size = [], 0, 1
    for kind, cap in STEPS:
        wider = margin + (cap if kind == "runs" else size)
        if window - 2 * wider < 2 * cap - 1:
            break
        chosen.append((kind, cap))
        margin, size = wider, cap
    return chosen, margin


def recompress(words: np.ndarray, text_of: np.ndarray, steps: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word, number of words) of the symbols of many texts; ``text_of`` is the text of each word."""
    name, start, size = words.copy(), np.arange(len(words)), np.ones(len(words), np.int64)
    for k, (kind, cap) in enumerate(steps):
        if len(name) < 2:
            break
        owner = text_of[start]
        if kind == "runs":
            head = np.ones(len(name), bool)
            head[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
            run = np.cumsum(head) - 1
            count, total = np.bincount(run), np.bincount(run, size).astype(np.int64)
            merged = (count > 1) & (total <= cap)
            keep = head | ~merged[run]
            new = np.where(merged[run], mix(name + count[run].astype(_U) * _U(0xA24BAED4963EE407)), name)
            name, start, size = new[keep], start[keep], np.where(merged[run], total[run], size)[keep]
        else:
            left = (mix(name ^ _U(k + 1)) & _U(1)).astype(bool)
            pair = np.zeros(len(name), bool)
            pair[:-1] = left[:-1] & ~left[1:] & (owner[:-1] == owner[1:]) & (size[:-1] + size[1:] <= cap)
            gone = np.zeros(len(name), bool)
            gone[1:] = pair[:-1]
            at = np.flatnonzero(pair)
            name[at] = mix(mix(name[at]) + name[at + 1] * _U(0x9FB21C651E98DF25))
            size[at] += size[at + 1]
            name, start, size = name[~gone], start[~gone], size[~gone]
    return name, start, size


class Ranges:
    """Hashes of word ranges from prefix sums of a polynomial in an odd base."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words) + 1
        up, down = np.full(n, base, _U), np.full(n, pow(base, -1, 1 << 64), _U)
        up[0] = down[0] = 1
        self.down = np.cumprod(down)
        self.sums = np.zeros(n, _U)
        np.cumsum(mix(words ^ _U(base)) * np.cumprod(up)[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(_U))


BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


class Batch:
    """Words, windows and their anchors for the texts of one batch."""

    def __init__(self, column: pa.Array, window: int):
        raw, offsets = text_bytes(column)
        starts, ends, self.first = words_of(raw, offsets)
        self.words = word_hashes(raw, starts, ends)
        self.counts = np.diff(self.first)
        text_of = np.repeat(np.arange(len(column)), self.counts)
        steps, margin = rounds(window)
        name, start, size = recompress(self.words, text_of, steps)
        end = start + size
        # All windows of the batch, by their first word.
        n = np.maximum(self.counts - window + 1, 0)
        self.text = np.repeat(np.arange(len(column)), n)
        self.window = np.repeat(self.first[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        low = np.searchsorted(start, self.window + margin)
        high = np.searchsorted(end, self.window + window - margin, "right") - 1
        order = mix(name ^ _U(0x5851F42D4C957F2D))
        best, best_order = low.copy(), order[low] if len(low) else order[:0]
        for k in range(1, window - 2 * margin):
            at = np.minimum(low + k, high)
            better = order[at] <= best_order  # the rightmost of equals
            best = np.where(better, at, best)
            best_order = np.where(better, order[at], best_order)
        self.anchor = start[best] if len(best) else best  # word index of each window's anchor
        chosen = np.unique(best)
        self.spot = start[chosen]
        self.spot_text = text_of[self.spot] if len(chosen) else chosen
        self.key = Ranges(self.words, BASES[0]).hashes(self.spot - margin, end[chosen] + margin) if len(chosen) else chosen.astype(_U)


def anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    """(row_id, doc_id, a, b, n_words, whole_sha256, keys, spots) of every row; (a, b) is the text's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("text")
            found = Batch(column, window)
            index = np.searchsorted(found.spot_text, np.arange(batch.num_rows + 1))
            shas = [hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for t in column.to_pylist()]
            yield pa.record_batch(
                [*(batch.column(c).cast(pa.int64()) for c in ("doc_id", "a", "b")), pa.array(found.counts, pa.int64()), pa.array(shas),
                 common.grouped(found.key.view(np.int64), index),
                 common.grouped((found.spot - found.first[found.spot_text]).astype(np.int32), index)],
                names=["doc_id", "a", "b", "n_words", "whole_sha256", "keys", "spots"])

    key = common.text_key(F.col("text"))
    rows = docs.select("doc_id", key["a"].alias("a"), key["b"].alias("b"), "text").mapInArrow(
        run, "doc_id long, a long, b long, n_words long, whole_sha256 string, keys array<long>, spots array<int>")
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def window_rows(texts: DataFrame, window: int) -> DataFrame:
    """(h1, h2, row_id, at) of the windows that chose one of the given ``spots``; ``texts`` is (row_id, text, spots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = Batch(batch.column("text"), window)
            spots = batch.column("spots")
            owner = np.repeat(np.arange(batch.num_rows), spots.value_lengths().to_numpy())
            wanted = found.first[owner] + spots.flatten().to_numpy()
            take = np.isin(found.anchor, wanted)
            at, text = found.window[take], found.text[take]
            ids = batch.column("row_id").to_numpy()
            step = 1 << 16
            both = [Ranges(found.words, b) for b in BASES]
            for k in range(0, len(at), step):
                part = at[k:k + step]
                h1, h2 = (r.hashes(part, part + window).view(np.int64) for r in both)
                yield pa.record_batch([pa.array(h1), pa.array(h2), pa.array(ids[text[k:k + step]]),
                                       pa.array((part - found.first[text[k:k + step]]).astype(np.int32))], names=["h1", "h2", "row_id", "at"])

    return texts.select("row_id", "text", "spots").mapInArrow(run, "h1 long, h2 long, row_id long, at int")


def cut_rows(texts: DataFrame, window: int) -> DataFrame:
    """(row_id, n_removed, kept_sha256, kept) for ``texts`` (row_id, text, ats): words covered by the windows at ``ats`` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            removed, shas = [], []
            for text, ats in zip(batch.column("text").to_pylist(), batch.column("ats"), strict=True):
                words = text.encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                at = ats.values.to_numpy()
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest())
            yield pa.record_batch([batch.column("row_id"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                                  names=["row_id", "n_removed", "kept_sha256"])

    return texts.select("row_id", "text", "ats").mapInArrow(run, "row_id long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, folder: str | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs`` (doc_id, text; further columns are ignored).

    A word goes when a window of ``window`` consecutive words covers it whose word sequence also starts elsewhere, in
    the same or another row; rows of equal text count as further places. Null and empty texts have no words. Null and
    repeated ids are rows like others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = folder or common.run_folder(spark, "substrings")
    rows = common.stored(anchor_rows(docs, window), f"{folder}/anchors")
    # The row that stands for all rows of its text.
    per_text = rows.groupBy("a", "b").agg(F.count("*").alias("copies"), F.min("row_id").alias("first_row"))
    shared = rows.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    first = rows.join(per_text.select(F.col("first_row").alias("row_id")), "row_id", "left_semi")
    spots = first.select("row_id", F.explode(F.arrays_zip("keys", "spots")).alias("s")).select(
        "row_id", F.col("s.keys").alias("key"), F.col("s.spots").alias("spot")).join(shared, "key").groupBy("row_id").agg(
        F.collect_list("spot").alias("spots"))
    wanted = common.stored(spots.join(rows.select("row_id", "doc_id", "a", "b"), "row_id"), f"{folder}/spots")
    key = common.text_key(F.col("text"))
    keyed = docs.select(F.col("doc_id").alias("own_id"), key["a"].alias("own_a"), key["b"].alias("own_b"), "text")
    texts = common.stored(
        keyed.join(wanted, (F.col("own_a") == F.col("a")) & (F.col("own_b") == F.col("b")) & F.col("own_id").eqNullSafe(F.col("doc_id")))
        .select("row_id", "text", "spots").dropDuplicates(["row_id"]), f"{folder}/texts")
    windows = common.stored(window_rows(texts, window), f"{folder}/windows")
    repeated = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    ats = windows.join(repeated, ["h1", "h2"]).groupBy("row_id").agg(F.collect_list("at").alias("ats"))
    cut = cut_rows(texts.join(ats, "row_id"), window)
    result = rows.select("row_id", "doc_id", "a", "b", "n_words", "whole_sha256").join(per_text, ["a", "b"]).join(
        cut.withColumnRenamed("row_id", "first_row"), "first_row", "left")
    copied = (F.col("copies") > 1) & (F.col("n_words") >= window)
    done = common.stored(result.select(
        "doc_id", "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256")), f"{folder}-cut")
    common.remove_folder(spark, folder)
    return done
