"""Near-duplicates by b-bit MinHash.

1. Every distinct text (by its word sequence) gets ``BANDS * ROWS`` minima over its 5-word shingles. Bands of ``ROWS``
   whole minima make bucket keys; of each minimum only the lowest ``BITS`` bits are kept, packed into a signature.
2. Candidates are members of one bucket. Their similarity is estimated by counting equal signature fields and
   corrected for fields that agree by chance: ``(equal - 2^-b) / (1 - 2^-b)``. Pairs clearly below the limit go.
3. Remaining pairs are confirmed exactly on the full shingle sets.

Only connections matter for the groups. First each text is compared with the smallest member of all its buckets. In
buckets whose members are then not in one component, likely pairs across components connect their texts to clusters,
and within a cluster all likely pairs across components are confirmed. Both steps compare pairs of blocks in bulk and give
only edges that connect something, so neither a bucket nor its pairs are ever gathered or emitted, and no connection
among candidates is lost, whatever the size of a bucket.

With a limit of 0.8 a pair at the limit misses all 32 bands of 4 rows with probability 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm import common
from martlens.llm.common import LOWER, mix, slices, text_bytes, word_hashes, words_of
from martlens.llm.components import components

SHINGLE, BANDS, ROWS, BITS = 5, 32, 4, 4
N_HASH = BANDS * ROWS
FIELDS = 64 // BITS  # signature fields in a long

#: Members of a block in the bulk comparison of buckets by signature.
BLOCK = 1024

#: The same where full shingle sets are compared.
SET_BLOCK = 128

_U32, _U64 = np.uint32, np.uint64
_ADD = mix(np.arange(1, N_HASH + 1, dtype=_U64)).astype(_U32)
_MUL = (mix(np.arange(1, N_HASH + 1, dtype=_U64) + _U64(1 << 32)) >> _U64(31)).astype(_U32) | _U32(1)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of the consecutive shingles of one text's word hashes; a shorter text is one shingle."""
    n = len(words)
    if n == 0:
        return np.zeros(0, _U64)
    size = min(n, SHINGLE)
    out = np.zeros(n - size + 1, _U64)
    for k in range(size):
        out = mix(out + words[k:n - size + 1 + k] + _U64(k))
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions; each is a bijection of 32 bits."""
    out = np.full(N_HASH, 0xFFFFFFFF, _U32)
    x = (shingles >> _U64(32)).astype(_U32)
    for at in range(0, len(x), 2048):
        y = x[at:at + 2048, None] * _MUL + _ADD
        y ^= y >> _U32(15)
        y *= _U32(0x2C1B3C6D)
        y ^= y >> _U32(13)
        np.minimum(out, y.min(axis=0), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different bands never share keys by intent."""
    rows = low.reshape(BANDS, ROWS).astype(_U64)
    key = np.arange(1, BANDS + 1, dtype=_U64) << _U64(40)
    for k in range(ROWS):
        key = mix(key + rows[:, k])
    return key


def packed(low: np.ndarray) -> np.ndarray:
    """The lowest BITS bits of each minimum, FIELDS of them in a 64-bit word."""
    field = (low & _U32((1 << BITS) - 1)).astype(_U64).reshape(-1, FIELDS)
    return (field << (np.arange(FIELDS, dtype=_U64) * _U64(BITS))).sum(axis=1, dtype=_U64)


def equal_fields(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal fields of signatures along the last axis, by counting bits."""
    differ = a ^ b
    for k in (1, 2):  # fold a field of four bits onto its lowest bit
        differ = differ | differ >> _U64(k)
    differ &= _U64(0x1111111111111111)
    return N_HASH - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity, corrected for fields that agree by chance."""
    chance = 2.0**-BITS
    return (equal_fields(a, b) / N_HASH - chance) / (1 - chance)


def lowest_estimate(limit: float) -> float:
    """Estimates of pairs at the limit are above this but for about one pair in a million."""
    chance = 2.0**-BITS
    agree = limit + (1 - limit) * chance
    return limit - 4.9 * float(np.sqrt(agree * (1 - agree) / N_HASH)) / (1 - chance)


def text_shingles(column: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text, its lower-cased words joined by one space, and its distinct shingle hashes."""
    raw, offsets = text_bytes(column)
    starts, ends, first = words_of(raw, offsets)
    hashes = word_hashes(raw, starts, ends, LOWER)
    low = LOWER[raw].tobytes()
    for i in range(len(column)):
        a, b = first[i], first[i + 1]
        yield b" ".join(low[offsets[i]:offsets[i + 1]].split()), np.unique(shingle_hashes(hashes[a:b]))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, words_key, bands, signature) of every row with a non-null id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            key, count, bands, signature = [], [], [], []
            for joined, shingles in text_shingles(batch.column("text")):
                low = minima(shingles)
                key.append(hashlib.blake2b(joined, digest_size=16).digest())
                count.append(len(shingles))
                bands.append(band_keys(low).view(np.int64) if len(shingles) else np.zeros(0, np.int64))
                signature.append(packed(low).tobytes() if len(shingles) else b"")
            flat = np.concatenate([*bands, np.zeros(0, np.int64)])
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), pa.array(count, pa.int64()), pa.array(key, pa.binary()),
                 common.grouped(flat, np.cumsum([0, *map(len, bands)])), pa.array(signature, pa.binary())],
                names=["doc_id", "n_shingles", "words_key", "bands", "signature"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, words_key binary, bands array<long>, signature binary")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _U64).reshape(len(column), N_HASH // FIELDS)


def likely(pairs: DataFrame, limit: float) -> DataFrame:
    """Pairs (a, b, n_a, n_b, sig_a, sig_b) that may reach the limit by size and estimate, as (a, b)."""
    least = lowest_estimate(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = estimate(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b"))) >= least
                yield batch.select(["a", "b"]).filter(pa.array(good))

    sized = pairs.where(F.least("n_a", "n_b") >= limit * F.greatest("n_a", "n_b") - 1e-6)
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def shingle_sets(nodes: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """(id, set) of the texts whose id is in ``nodes``; a filter of fixed size keeps most others out of the shuffle."""
    held = texts.sparkSession.sparkContext.broadcast(common.id_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole.filter(pa.array(common.may_hold(held.value, whole.column("doc_id").cast(pa.int64()))))])):
                found = [s for _, s in text_shingles(batch.column("text"))]
                yield pa.record_batch([batch.column("doc_id").cast(pa.int64()),
                                       pa.array([s.tobytes() for s in found], pa.binary())], names=["id", "set"])

    return common.stored(texts.mapInArrow(run, "id long, set binary").join(nodes, "id", "left_semi").dropDuplicates(["id"]), folder)


def reaches(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have ``100 * intersection >= percent * union``."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= percent * (len(p) + len(q) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the limit on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [reaches(np.frombuffer(x.as_buffer(), _U64), np.frombuffer(y.as_buffer(), _U64), percent)
                    for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
    return with_a.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b").select(
        "a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def star_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket (bucket, id) with the smallest member of all its buckets: one pair (a, b) for each b."""
    lowest = members.groupBy("bucket").agg(F.min("id").alias("low"))
    return members.join(lowest, "bucket").groupBy(F.col("id").alias("b")).agg(F.min("low").alias("a")).where("a < b").select("a", "b")


class _Rows:
    """The members of a pair of blocks, and which of them are to be compared."""

    def __init__(self, table: pa.Table):
        self.id, self.n, self.component, side = (table[c].to_numpy() for c in ("id", "n", "component", common.SIDE))
        self.signature = _signatures(table["signature"].combine_chunks())
        self.left, self.right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)

    def partners(self, x: int, group: np.ndarray, limit: float, least: float) -> np.ndarray:
        """Rows on the right that ``x`` may be linked with and that are in another ``group``."""
        y = self.right
        y = y[(group[y] != group[x]) & (np.minimum(self.n[y], self.n[x]) >= limit * np.maximum(self.n[y], self.n[x]) - 1e-6)]
        return y[estimate(self.signature[y], self.signature[x]) >= least] if len(y) else y


def likely_edges(members: DataFrame, limit: float, folder: str | None = None) -> DataFrame:
    """Edges (a, b) that connect all members of a bucket that are likely linked across components.

    ``members`` is (bucket, id, n, signature, component). Only edges that join what is still apart are given, fewer
    than rows for each pair of blocks.
    """
    least = lowest_estimate(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, ["bucket", *common.PAIR]):
            rows = _Rows(table)
            root = np.arange(len(rows.id))
            a, b = [], []
            for x in rows.left:
                y = rows.partners(x, rows.component, limit, least)
                apart, first = np.unique(root[y], return_index=True)
                new = apart != root[x]
                if new.any():
                    a += [rows.id[x]] * int(new.sum())
                    b += rows.id[y[first[new]]].tolist()
                    root[np.isin(root, apart)] = root[x]
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return common.block_pairs(members, "bucket", BLOCK, folder).mapInArrow(run, "a long, b long").distinct()


def cluster_links(members: DataFrame, percent: int, folder: str | None = None) -> DataFrame:
    """Confirmed links (a, b) between the components of each cluster, fewer than rows for each pair of blocks.

    ``members`` is (cluster, id, n, signature, component, set). Every likely pair across components is compared on its
    full sets in the task that holds its two blocks, unless links found before already connect it.
    """
    limit, least = percent / 100, lowest_estimate(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, ["cluster", *common.PAIR]):
            rows = _Rows(table)
            sets = [np.frombuffer(s.as_buffer(), _U64) for s in table["set"]]
            group = rows.component.copy()
            a, b = [], []
            for x in rows.left:
                for y in rows.partners(x, group, limit, least):
                    if group[y] != group[x] and reaches(sets[x], sets[y], percent):
                        a.append(rows.id[x])
                        b.append(rows.id[y])
                        group[group == group[y]] = group[x]
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return common.block_pairs(members, "cluster", SET_BLOCK, folder).mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, percent: int = 80, folder: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; further columns are ignored).

    Texts are linked when 100 times their common shingles are at least ``percent`` times all shingles of both.
    component_id is the smallest doc_id that can be reached, kept marks its row. Texts without words and null texts
    have no shingles and are linked with nothing; rows with a null id are their own group with a null component and
    are kept. Rows that repeat an id (with any text) share one component; rows with the same id and text are all
    kept or all not.
    """
    spark = docs.sparkSession
    folder = folder or common.run_folder(spark, "minhash")
    texts = docs.select("doc_id", "text")
    own = common.stored(sketches(texts), f"{folder}/sketches")
    filled = own.where("n_shingles > 0 and doc_id is not null")
    # Equal word sequences are linked with their smallest id; only that one goes on.
    first = filled.groupBy("words_key").agg(F.min(F.struct("doc_id", "n_shingles", "signature", "bands")).alias("r")).select("words_key", "r.*")
    copies = filled.select("doc_id", "words_key").join(first.select("words_key", F.col("doc_id").alias("first_id")), "words_key").where(
        "doc_id <> first_id").select(F.col("first_id").alias("a"), F.col("doc_id").alias("b")).distinct()
    nodes = common.stored(first.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signature", "bands"), f"{folder}/nodes")
    entries = nodes.select("id", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = common.stored(entries.join(shared, "bucket"), f"{folder}/members")
    sig = nodes.select("id", "n", "signature")

    def with_signatures(pairs: DataFrame) -> DataFrame:
        a = sig.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("sig_a"))
        b = sig.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("sig_b"))
        return pairs.join(a, "a").join(b, "b")

    pairs = common.stored(likely(with_signatures(star_pairs(members)), percent / 100), f"{folder}/pairs")
    sets = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), texts, f"{folder}/pair-sets")
    links = common.stored(confirmed(pairs, sets, percent), f"{folder}/links")
    group = components(links, f"{folder}/stars")
    named = members.join(group, F.col("id") == F.col("node"), "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    edges = common.stored(likely_edges(named.join(mixed, "bucket").join(sig, "id"), percent / 100, f"{folder}/apart"), f"{folder}/edges")
    clusters = components(edges, f"{folder}/clusters").select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    sets = shingle_sets(clusters.select("id"), texts, f"{folder}/cluster-sets")
    in_cluster = clusters.join(group, F.col("id") == F.col("node"), "left").select(
        "cluster", "id", F.coalesce("component", "id").alias("component")).join(sig, "id").join(sets, "id")
    more = common.stored(cluster_links(in_cluster, percent, f"{folder}/cluster-rows"), f"{folder}/more-links")
    group = components(links.union(more).union(copies), f"{folder}/groups")
    result = own.join(group, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    done = common.stored(result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), f"{folder}-groups")
    common.remove_folder(spark, folder)
    return done


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` that are the smallest id of their group; all columns as they were."""
    away = near_groups(docs, percent).where("not kept").select(F.col("doc_id").alias("near_copy_id")).distinct()
    return docs.join(away, docs.doc_id == away.near_copy_id, "left_anti")
