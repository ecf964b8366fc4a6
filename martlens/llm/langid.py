"""Language identification: family first, then one-versus-one linear support vector machines within the family.

A text is a unit vector of hashed letter n-grams (one to three bytes of the lower-cased UTF-8 letters, words padded by
a space). The first level separates language families, the second the languages of one family; on each level every
pair of classes has a linear support vector machine, and the class with most votes wins, ties going to the larger sum of margins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm import common
from martlens.llm.common import LOWER, slices, text_bytes

#: Hash dimensions of the n-grams.
DIMS = 2048

# Families of common language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "sr", "hr", "sl"),
    "uralic": ("fi", "hu", "et"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

UNKNOWN = "und"

#: By byte: letters (ASCII letters and all bytes of other characters) lower-cased, everything else a space.
_GRAM_BYTE = np.full(256, 32, np.uint8)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalpha():
        _GRAM_BYTE[_b] = LOWER[_b]


def gram_vectors(column: pa.Array) -> np.ndarray:
    """One row per text: unit-length square roots of the n-gram counts."""
    raw, offsets = text_bytes(column)
    n = len(offsets) - 1
    counts = np.zeros((n, DIMS), np.float32)
    step = 1 << 20
    for at in range(0, len(raw), step):  # pieces bound the temporary arrays; one byte before and after belongs to the grams
        low, high = max(at - 2, 0), min(at + step, len(raw))
        x = _GRAM_BYTE[raw[low:high]].astype(np.uint32)
        row = np.searchsorted(offsets, np.arange(low, high), "right") - 1
        first, last = int(row[0]), int(row[-1])
        mine = np.arange(low, high) >= at
        for size in (1, 2, 3):
            h = np.zeros(max(len(x) - size + 1, 0), np.uint32)
            for k in range(size):
                h = h * np.uint32(0x01000193) + x[k:len(x) - size + 1 + k]
            if not len(h):
                continue
            tail = slice(size - 1, len(x))
            keep = (row[tail] == row[:len(h)]) & mine[tail] & ~((x[tail] == 32) & (x[:len(h)] == 32))
            h = (h ^ np.uint32(size * 0x1E3779B1)) * np.uint32(0x85EBCA6B)
            cell = (row[:len(h)][keep] - first).astype(np.int64) * DIMS + (h[keep] >> np.uint32(21)).astype(np.int64)
            counts[first:last + 1] += np.bincount(cell, minlength=(last - first + 1) * DIMS).reshape(-1, DIMS)
    np.sqrt(counts, out=counts)
    norm = np.sqrt((counts**2).sum(1, keepdims=True))
    return counts / np.maximum(norm, 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, *, ridge: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Weights (last one the bias) of a linear machine with squared hinge loss; y is -1 or 1, classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, speed = np.zeros(x.shape[1] + 1, np.float32), np.zeros(x.shape[1] + 1, np.float32)
    rate = 1 / (2 * 2.0 + ridge)  # rows have unit length, plus the bias
    for step in range(steps):  # Nesterov's accelerated gradient
        ahead = w + speed
        slack = np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1])) * weight
        grad = np.append(-2 * (slack * y) @ x, -2 * (slack * y).sum()) + ridge * np.append(ahead[:-1], 0)
        new = ahead - rate * grad
        speed = (step / (step + 3)) * (new - w)
        w = new
    return w


class Machines:
    """One-versus-one machines over some classes."""

    def __init__(self, classes: list[str], x: np.ndarray, of: np.ndarray):
        self.classes = classes
        self.pairs = [(a, b) for a in range(len(classes)) for b in range(a + 1, len(classes))]
        self.weights = np.zeros((len(self.pairs), x.shape[1] + 1), np.float32)
        for k, (a, b) in enumerate(self.pairs):
            mine = (of == a) | (of == b)
            self.weights[k] = fit_svm(x[mine], np.where(of[mine] == a, 1.0, -1.0).astype(np.float32))

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class index and confidence (0 to 1) of each row: the logistic of its weakest won duel."""
        if len(self.classes) == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, total = np.zeros((len(x), len(self.classes))), np.zeros((len(x), len(self.classes)))
        for k, (a, b) in enumerate(self.pairs):
            votes[:, a] += margin[:, k] > 0
            votes[:, b] += margin[:, k] <= 0
            total[:, a] += margin[:, k]
            total[:, b] -= margin[:, k]
        best = np.argmax(votes + 1e-3 * np.tanh(total), axis=1)
        weakest = np.full(len(x), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            weakest = np.where(best == a, np.minimum(weakest, margin[:, k]), weakest)
            weakest = np.where(best == b, np.minimum(weakest, -margin[:, k]), weakest)
        return best, 1 / (1 + np.exp(-2 * weakest))


class Model:
    """Machines for families, and for the languages of each family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        family = np.array([FAMILY_OF.get(v, f"own:{v}") for v in langs], object)
        self.families = sorted(set(family))
        self.top = Machines(self.families, x, np.array([self.families.index(f) for f in family], np.int64)) if len(langs) else None
        self.within = {}
        for f in self.families:
            own = sorted(set(langs[family == f]))
            self.within[f] = Machines(own, x[family == f], np.array([own.index(v) for v in langs[family == f]], np.int64))

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        lang, score = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
        if self.top is None:
            return lang.tolist(), score
        x = gram_vectors(column)
        best, sure = self.top.decide(x)
        for k, f in enumerate(self.families):
            at = np.flatnonzero(best == k)
            if len(at):
                inner, inner_sure = self.within[f].decide(x[at])
                lang[at] = np.array(self.within[f].classes, object)[inner]
                score[at] = sure[at] * inner_sure
        for i, text in enumerate(column.to_pylist()):
            if not text or not any(map(str.isalpha, text)):
                lang[i], score[i] = UNKNOWN, 0.0
        return lang.tolist(), score


def train(docs: DataFrame, learn: Column, per_language: int = 1500) -> Model:
    """Fit on at most about ``per_language`` documents of each non-null lang, chosen by a hash among rows that ``learn`` admits."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    u = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 11) / float(1 << 53)
    share = F.coalesce(*[F.when(F.col("lang") == lang, per_language / n) for lang, n in sizes.items()], F.lit(0.0))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = gram_vectors(batch.column("text")).astype(np.float16)
            yield pa.record_batch([batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])

    rows = known.where(u <= share).select("lang", "text").mapInArrow(vectors, "lang string, x binary").collect()
    x = np.frombuffer(b"".join(r.x for r in rows), np.float16).reshape(-1, DIMS).astype(np.float32)
    return Model(x, np.array([r.lang for r in rows], object))


SCHEMA = "doc_id long, lang_pred string, score double"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; ``und`` with score 0 if the text is null or has no letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score = model.predict(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score)],
                                  names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def languages(docs: DataFrame, *, folds: int = 4, held: int = 2, per_language: int = 1500) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang).

    Only rows whose crc32 of the id modulo ``folds`` is not ``held`` are learned from. A null id is not held out and
    not learned from. Without any language to learn every text is ``und``. Repeated rows each give a row.
    """
    remainder = common.id_remainder(F.col("doc_id"), folds)
    model = train(docs, remainder != held, per_language)
    return identify(docs, model).select(
        "doc_id", F.coalesce(remainder == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
