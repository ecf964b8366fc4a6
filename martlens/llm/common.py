"""Shared parts: folders of the run, vectorised word hashing, small expressions.

Word hashing works on the UTF-8 bytes of an Arrow string column, so a task never loops over words in Python. A batch
is cut into pieces of about ``PIECE`` bytes at white space, which bounds the temporary arrays even for a very long text.
"""

from __future__ import annotations

import io
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import files

#: Bytes worked on at once.
PIECE = 1 << 18

_U = np.uint64


# -- folders -----------------------------------------------------------------------------------------------------------
def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every executor reaches."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder through the Hadoop file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def attach(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark context, where it is not installed on them."""
    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if getattr(context, "_martlens_attached", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    folder = run_folder(spark, "package")
    files.make_folder(folder)
    files.write_file(f"{folder}/martlens-package.zip", [packed.getvalue()])
    context.addPyFile(f"{folder}/martlens-package.zip")
    context._martlens_attached = True


def stored(df: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, survives lost executors."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- expressions -------------------------------------------------------------------------------------------------------
def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def text_key(text: Column) -> Column:
    """128-bit key of a text; null and empty texts share one key."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit(1), whole).alias("b"))


# -- a filter of fixed size ------------------------------------------------------------------------------------------------
#: Bits of an id filter; 1 MB whatever the number of ids. More ids than about a million let more strangers pass.
FILTER_BITS = 1 << 23


def _filter_places(ids: np.ndarray) -> np.ndarray:
    """Three bit places for each id."""
    x = ids.astype(np.int64).view(np.uint64)
    return np.stack([mix(x + np.uint64(k << 40)) % np.uint64(FILTER_BITS) for k in (1, 2, 3)])


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits that hold every id of a one-column table; ``may_hold`` says no to most others. Used to leave rows out of a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            place = _filter_places(batch.column(0).drop_null().to_numpy()).ravel()
            np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pa.record_batch([pa.array(at), pa.array(words[at].view(np.int64))], names=["at", "word"])

    parts = ids.mapInArrow(run, "at long, word long").groupBy("at").agg(F.expr("bit_or(word)").alias("word"))
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for at, word in parts.collect():  # 131,072 rows at most
        words[at] = word
    return words.view(np.uint64)


def may_hold(words: np.ndarray, ids: pa.Array) -> np.ndarray:
    """True for every id of the filter, and for few others; null is never held."""
    place = _filter_places(ids.fill_null(0).to_numpy(zero_copy_only=False))
    bits = words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)
    return bits.all(axis=0) & ~ids.is_null().to_numpy(zero_copy_only=False)


# -- bytes of a batch --------------------------------------------------------------------------------------------------
def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def is_white() -> np.ndarray:
    """By byte: true for 0x20 and 0x09 to 0x0D."""
    white = np.zeros(256, bool)
    white[[0x20, *range(0x09, 0x0E)]] = True
    return white


def lower_table() -> np.ndarray:
    """By byte: A to Z become a to z, all others stay."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    return low


WHITE, LOWER = is_white(), lower_table()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    n = 2 * PIECE + 2
    up = np.full(n, base, _U)
    up[0] = 1
    down = np.full(n, pow(base, -1, 1 << 64), _U)
    down[0] = 1
    letters = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
    return np.cumprod(up), np.cumprod(down), letters


_TABLES: list = []


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte ranges, which are in order and do not overlap; ``table`` maps bytes first."""
    if not _TABLES:
        _TABLES.extend(_powers())
    up, down, letters = _TABLES
    if table is not None:
        letters = letters[table]
    out = np.zeros(len(starts), _U)
    i, n = 0, len(starts)
    while i < n:
        first = int(starts[i])
        j = int(np.searchsorted(ends, first + PIECE, "right"))
        if j <= i:  # one word longer than a piece
            word = raw[first:int(ends[i])]
            word = table[word] if table is not None else word
            out[i] = np.frombuffer(_long_word(word.tobytes()), _U)[0]
            i += 1
            continue
        part = raw[first:int(ends[j - 1])]
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(letters[part] * up[:len(part)], out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(_U)
        i = j
    return mix(out)


def _long_word(word: bytes) -> bytes:
    import hashlib

    return hashlib.blake2b(word, digest_size=8).digest()


def words_of(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words of a batch and, for each text, the index of its first word (n + 1 values)."""
    out_s, out_e = [], []
    step = 4 * PIECE
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    for at in range(0, len(raw), step):
        part = ~separator[raw[at:at + step]]
        before = np.empty(len(part), bool)
        before[0] = at > 0 and not separator[raw[at - 1]]
        before[1:] = part[:-1]
        out_s.append(np.flatnonzero(part & (~before | edge[at:at + len(part)])) + at)
        after = np.empty(len(part), bool)
        after[-1] = at + len(part) < len(raw) and not separator[raw[at + len(part)]]
        after[:-1] = part[1:]
        out_e.append(np.flatnonzero(part & (~after | edge[at + 1:at + len(part) + 1])) + at + 1)
    starts = np.concatenate(out_s) if out_s else np.zeros(0, np.int64)
    ends = np.concatenate(out_e) if out_e else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 * PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` text bytes; a longer text is alone in its batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        whole = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            done = whole[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(whole, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal integer ``keys``, from input that is sorted by them; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


#: Columns that name a pair of blocks within a group, and the side a row is on: 0 the first, 1 the second, 2 both.
PAIR, SIDE = ["home_i", "slice_i", "home_j", "slice_j"], "side"


def block_pairs(rows: DataFrame, group: str, size: int, folder: str | None = None) -> DataFrame:
    """``rows`` (group, component, id and others) once for each pair of blocks it takes part in, with ``PAIR`` and ``SIDE``.

    Blocks are made from counts alone: a component with more than a quarter of ``size`` rows in a group fills blocks of
    its own, dealt by a hash of the id; smaller ones are dealt whole, by a hash of the component, to blocks that hold
    several. A block has about half of ``size`` rows. Two blocks of one component make no pair. The rows of a pair come
    one after the other, so a task compares them without ever holding a group. ``rows`` and the layout are used several
    times; with a ``folder`` both are stored, which keeps the plan, and the driver's memory for it, small.
    """
    half = max(size // 2, 1)
    rows = stored(rows, f"{folder}/rows") if folder else rows
    counted = rows.groupBy(group, "component").agg(F.count("*").alias("n_own"))
    own = F.col("n_own") > size // 4

    def slices_of(n: Column) -> Column:
        return F.when(n <= size, 1).otherwise(F.ceil(n / half)).cast("long")

    small = counted.groupBy(group).agg(F.sum(F.when(~own, F.col("n_own"))).alias("n_small"))
    layout = counted.join(small, group).select(group, "component", own.alias("own"), slices_of(F.when(own, F.col("n_own")).otherwise(F.col("n_small"))).alias("n_slices"))
    layout = stored(layout, f"{folder}/layout") if folder else layout
    # Slices of shared blocks are negative, so that no component's number is taken for another's.
    placed = rows.join(layout, [group, "component"]).withColumn("home", F.when(F.col("own"), F.col("component")).otherwise(0).cast("long")).withColumn(
        "slice", F.when(F.col("own"), F.pmod(F.xxhash64("id"), "n_slices")).otherwise(-1 - F.pmod(F.xxhash64("component"), "n_slices"))).drop("own", "n_slices")
    blocks = layout.select(group, F.when(F.col("own"), F.col("component")).otherwise(0).cast("long").alias("home"), "own", "n_slices").distinct().select(
        group, "home", F.explode(F.when(F.col("own"), F.sequence(F.lit(0).cast("long"), F.col("n_slices") - 1)).otherwise(
            F.sequence(-F.col("n_slices"), F.lit(-1).cast("long")))).alias("slice"))
    i = blocks.select(group, F.col("home").alias("home_i"), F.col("slice").alias("slice_i"))
    j = blocks.select(F.col(group).alias("group_j"), F.col("home").alias("home_j"), F.col("slice").alias("slice_j"))
    first, second = F.struct(F.col("home_i").alias("home"), F.col("slice_i").alias("slice")), F.struct(F.col("home_j").alias("home"), F.col("slice_j").alias("slice"))
    one_component = (F.col("slice_i") >= 0) & (F.col("slice_j") >= 0) & (F.col("home_i") == F.col("home_j"))
    pairs = i.join(j, (F.col(group) == F.col("group_j")) & (first <= second) & ~one_component)
    taken = pairs.select(group, *PAIR, F.explode(F.when(first == second, F.array(F.struct(first.alias("b"), F.lit(2).alias(SIDE)))).otherwise(
        F.array(F.struct(first.alias("b"), F.lit(0).alias(SIDE)), F.struct(second.alias("b"), F.lit(1).alias(SIDE))))).alias("t")).select(
        group, *PAIR, F.col("t.b.home").alias("home"), F.col("t.b.slice").alias("slice"), f"t.{SIDE}")
    return placed.join(taken, [group, "home", "slice"]).drop("home", "slice").repartition(group, *PAIR).sortWithinPartitions(group, *PAIR, "component", "id")


def grouped(lists: np.ndarray, index: np.ndarray) -> pa.ListArray:
    """List column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(index, pa.int32()), pa.array(lists))


def crc(data: bytes) -> int:
    return zlib.crc32(data)
