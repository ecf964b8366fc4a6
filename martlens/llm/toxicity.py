"""Toxicity by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic texts (positives) and unlabelled texts, never confirmed clean ones. With the class
prior p, the risk of a scorer g is estimated as ``p R+(g, 1) + max(0, Ru(g, 0) - p R+(g, 0))``: the unlabelled part
minus what positives contribute to it estimates the risk on clean texts, and must not become negative.

Steps: (1) on executors, count in how many distinct texts of the corpus, and of the positives among them, each hashed
word occurs, and keep the words that a G test calls telling; (2) choose by a hash at most about ``max_positive``
positives and ``max_unlabelled`` documents, one for each distinct text; (3) fit a linear model with numpy on the kept
words of that sample; (4) score every whole text of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm import common
from martlens.llm.common import LOWER, WHITE, slices, text_bytes, word_hashes, words_of

#: Hash buckets for words.
BUCKETS = 1 << 18

#: Bytes that separate words: white space and ASCII punctuation.
_SEPARATOR = WHITE.copy()
_SEPARATOR[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def bucket_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of a batch as two arrays, ordered by row."""
    raw, offsets = text_bytes(column)
    starts, ends, first = words_of(raw, offsets, _SEPARATOR)
    buckets = (word_hashes(raw, starts, ends, LOWER) >> np.uint64(46)).astype(np.int64)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    pairs = np.unique(row * BUCKETS + buckets)
    return pairs // BUCKETS, pairs % BUCKETS


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n_positive, n_all) over rows (text, positive), each text counted once per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches):
            row, bucket = bucket_sets(batch.column("text"))
            positive = batch.column("positive").fill_null(False).to_numpy(zero_copy_only=False)
            total[0] += np.bincount(bucket[positive[row]], minlength=BUCKETS)
            total[1] += np.bincount(bucket, minlength=BUCKETS)
        seen = np.flatnonzero(total[1])
        if len(seen):
            yield pa.record_batch([pa.array(seen), *(pa.array(t[seen]) for t in total)], names=["bucket", "n_positive", "n_all"])

    part = rows.select("text", "positive").mapInArrow(count, "bucket long, n_positive long, n_all long")
    return part.groupBy("bucket").agg(F.sum("n_positive").alias("n_positive"), F.sum("n_all").alias("n_all"))


def telling_buckets(counts: DataFrame, positives: int, total: int, most: int) -> np.ndarray:
    """The ``most`` buckets (a bound of the model, not of the corpus) with the largest G statistic, above 12."""
    p, n = F.col("n_positive").cast("double"), F.col("n_all").cast("double")
    share = positives / max(total, 1)
    inside = F.when(p > 0, p * F.log(p / (n * share))).otherwise(0.0)
    outside = F.when(n > p, (n - p) * F.log((n - p) / (n * (1 - share)))).otherwise(0.0)
    rare = (n - p + 1) / (n + 1)
    top = (counts.where((p >= 3) | (rare >= 0.999)).withColumn("g", 2 * (inside + outside)).where("g > 12")
           .orderBy(F.desc("g"), "bucket").limit(most).select("bucket"))
    return np.sort(np.array([r.bucket for r in top.collect()], np.int64))


def features(column: pa.Array, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs: which of the kept buckets occur in each text."""
    row, bucket = bucket_sets(column)
    at = np.searchsorted(kept, bucket)
    hit = at < len(kept)
    hit[hit] = kept[at[hit]] == bucket[hit]
    return row[hit], at[hit]


class Model:
    """Linear scorer over bucket presence; ``score`` is the estimated probability of toxicity."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float):
        self.kept, self.weights, self.bias = kept, weights, bias

    def score(self, column: pa.Array) -> np.ndarray:
        row, feature = features(column, self.kept)
        margin = self.bias + np.bincount(row, self.weights[feature], minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_nnpu(rows_p: list[list[int]], rows_u: list[list[int]], n_features: int, prior: float, *,
             steps: int = 600, rate: float = 0.05, ridge: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss; full batches, Adam."""

    def flat(rows):
        return (np.repeat(np.arange(len(rows)), [len(r) for r in rows]),
                np.fromiter((f for r in rows for f in r), np.int64))

    (pr, pf), (ur, uf) = flat(rows_p), flat(rows_u)
    n_p, n_u = max(len(rows_p), 1), max(len(rows_u), 1)
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for step in range(1, steps + 1):
        s_p = sigmoid(b + np.bincount(pr, w[pf], minlength=len(rows_p)))
        s_u = sigmoid(b + np.bincount(ur, w[uf], minlength=len(rows_u)))
        clean = -np.log(1 - s_u + 1e-12).sum() / n_u + prior * np.log(1 - s_p + 1e-12).sum() / n_p
        d_p, d_u = -prior * (1 - s_p) / n_p, np.zeros_like(s_u)
        if clean >= 0:
            d_p, d_u = d_p - prior * s_p / n_p, s_u / n_u
        else:  # the clean part went below zero: step back along it
            d_p, d_u = prior * s_p / n_p, -s_u / n_u
        grad = np.append(np.bincount(pf, d_p[pr], minlength=n_features) + np.bincount(uf, d_u[ur], minlength=n_features)
                         + ridge * w, d_p.sum() + d_u.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, prior: float | None = None, max_features: int = 2048,
          max_positive: int = 20_000, max_unlabelled: int = 40_000) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); ``learn`` tells which rows' labels may be used.

    Positives are documents with toxic = 1; each distinct text counts once. All documents serve as unlabelled ones.
    ``prior`` is the share of toxic documents; without it the share of toxic labels stands for it. Without a positive
    the model gives every text the prior.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(
        learn).select("doc_id", (F.col("toxic") == 1).alias("positive"))
    said = known.agg(F.count("*").alias("n"), F.sum(F.col("positive").cast("long")).alias("p")).first()
    if prior is None:
        prior = min(max((said.p or 0) / max(said.n, 1), 1e-4), 0.9)
    empty = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not said.p:
        return empty
    # One row for each text (by its 128-bit key): copies would make the words of one document look telling.
    keyed = docs.select("doc_id", common.text_key("text").alias("key"))
    first = (keyed.join(known.where("positive"), "doc_id", "left").groupBy("key")
             .agg(F.max(F.coalesce("positive", F.lit(False))).alias("positive"), F.min("doc_id").alias("doc_id"),
                  F.min(F.xxhash64("doc_id")).alias("mark")))
    counted = first.agg(F.count("*").alias("n"), F.sum(F.col("positive").cast("long")).alias("p")).first()
    if not counted.p:
        return empty
    # The mark names one row of each text, also where the id is null, and spreads the copies of a usual text over tasks.
    marked = docs.select("text", common.text_key("text").alias("key"), F.xxhash64("doc_id").alias("mark"))
    distinct = marked.join(first.select("key", "mark", "positive"), ["key", "mark"]).dropDuplicates(["key", "mark"])
    kept = telling_buckets(bucket_counts(distinct), counted.p, counted.n, max_features)
    rank = F.xxhash64(F.lit("sample"), "doc_id")
    share_p, share_u = min(1.0, max_positive / counted.p), min(1.0, max_unlabelled / counted.n)
    chosen = first.select("doc_id", "positive", (F.shiftrightunsigned(rank, 11) / float(1 << 53)).alias("u"))
    chosen = chosen.select("doc_id", (F.col("positive") & (F.col("u") <= share_p)).alias("as_p"),
                           (F.col("u") <= share_u).alias("as_u")).where("as_p or as_u")
    # The sample is bounded, so it goes to the texts, and only features are shuffled for it.
    picked = docs.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "as_p", "as_u")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, feature = features(batch.column("text"), kept)
            index = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.record_batch([batch.column("doc_id"), common.grouped(feature.astype(np.int32), index), batch.column("as_p"), batch.column("as_u")],
                                  names=["doc_id", "f", "as_p", "as_u"])

    sample = picked.mapInArrow(sparse, "doc_id long, f array<int>, as_p boolean, as_u boolean").dropDuplicates(["doc_id"]).collect()
    w, b = fit_nnpu([r.f for r in sample if r.as_p], [r.f for r in sample if r.as_u], len(kept), prior)
    return Model(kept, w, b)


SCHEMA = "doc_id long, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs``; null and empty texts get the score of a text without known words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(model.score(batch.column("text")))],
                                  names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose score is below the threshold, all columns as they were."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(model.score(batch.column("text")) < threshold))

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Rows whose crc32 of the id modulo ``folds`` is ``held`` are held out: their labels are not used. A null id is not
    held out and has no label. Repeated rows each give a row; empty tables give no rows; further columns are ignored.
    """
    model = train(docs, labels, common.id_remainder(F.col("doc_id"), folds) != held, **options)
    scored = score(docs, model)
    out = F.coalesce(common.id_remainder(F.col("doc_id"), folds) == held, F.lit(False))
    return scored.select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
