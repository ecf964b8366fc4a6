"""Token ids in binary files.

Ids are replaced by their frequency rank over the whole corpus, so frequent ids are small, and a rank takes one to four
bytes. Byte lengths stand apart from the data: a control byte holds the lengths (less one, two bits each, lowest bits
first) of four ranks. A reader looks up each control byte in a 256-row table, which gives the four lengths at once, and
gathers all ranks of a file without a loop.

File: magic, u32 documents, u64 ids, then per document doc_id i64, null flag u8 and ids u32, then all control bytes,
then all data bytes. Each document starts a new control byte. ``codebook.bin`` holds the id of each rank as u32, the
table ``files`` each file with the ids before it. Files hold documents in ascending doc_id order (null first), and file
names sort the same way.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.llm import common, files
from martlens.llm.common import LOWER, slices, text_bytes, word_hashes

MAGIC = b"RVB2"
HEAD = "<4sIQ"

#: Ids after which a file is closed, ids of a range that one task writes, and files that one task reads.
FILE_IDS, RANGE_IDS, READ_FILES = 4_000_000, 32_000_000, 4

#: Bytes of the pieces and ids that a worker remembers, but for those of one batch.
CACHE_BYTES = 40_000_000


# -- variable-length coding --------------------------------------------------------------------------------------------
#: Row c: the byte lengths of the four ranks that control byte c describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def encode(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of documents with ``counts`` unsigned 32-bit ranks each.

    Gives the control bytes, the n + 1 offsets of the documents in them, the data bytes, and their offsets.
    """
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    groups = np.concatenate([[0], np.cumsum(-(-counts // 4))])
    index = np.concatenate([[0], np.cumsum(counts)])
    code = np.zeros(4 * int(groups[-1]), np.uint8)
    code[np.arange(len(ranks)) + np.repeat(4 * groups[:-1] - index[:-1], counts)] = size - 1
    four = code.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    return control.astype(np.uint8), groups, ranks.view(np.uint8).reshape(-1, 4)[used], ends[index]


def decode(control: np.ndarray, counts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Ranks of documents with ``counts`` ids each, from their joined control and data bytes."""
    size = LENGTHS[control].reshape(-1)
    groups = -(-counts // 4)
    spare = np.repeat(np.cumsum(4 * groups) - 4 * groups - (np.cumsum(counts) - counts), counts)
    size = size[np.arange(int(counts.sum())) + spare]  # without the unused places of each last control byte
    start = np.cumsum(size, dtype=np.int64) - size
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    ranks = padded[start].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        ranks[longer] |= padded[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


# -- words to ids ------------------------------------------------------------------------------------------------------
def _piece_classes() -> np.ndarray:
    """By byte: 1 for ASCII letters, 2 for digits, 3 for other visible ASCII but the apostrophe, 0 for all else."""
    kinds = np.zeros(256, np.uint8)
    for b in range(0x21, 0x7F):
        c = chr(b)
        kinds[b] = 1 if c.isalpha() else 2 if c.isdecimal() else 0 if c == "'" else 3
    return kinds


PIECE_CLASS = _piece_classes()


def pieces_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces that the tokenizer splits too, and the index of each text's first one (n + 1 values).

    Pieces end at white space, between an ASCII letter, digit or other sign and one of another class, and after each
    digit. An apostrophe and bytes beyond ASCII are never parted from their neighbours.
    """
    kind, white = PIECE_CLASS[raw], common.WHITE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[1:-1] = (white[1:] != white[:-1]) | ((kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2)))
    edge[offsets] = True
    edge[[0, -1]] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    held = ~white[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[held], ends[held]
    return starts, ends, np.searchsorted(starts, offsets)


#: Pieces encoded in one call, with a sign between them that is a token of its own.
JOINED, MARK = 256, "|"


class WordEncoder:
    """Ids of whole texts, looked up piece by piece.

    The tokenizer itself drops white space and parts letters, digits and other signs, so the ids of a text are those of
    its pieces in a row; a piece is encoded once per worker while it is remembered. Lower-casing A to Z first changes
    nothing, as the tokenizer does it too. This holds only for tokenizers that say so in their file (``by_words``); for
    any other, and for texts that hold the start of a special token, whole texts are encoded.

    What is remembered are four arrays, ``CACHE_BYTES`` at most; beyond that, pieces met only once are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = _drops_white_space(path)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.keep(np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32))

    def keep(self, kept: np.ndarray, keys: np.ndarray, index: np.ndarray, ids: np.ndarray) -> None:
        """Remember the ``kept`` ones of the pieces with these sorted hashes; piece k has ids index[k] to index[k + 1]."""
        length = np.diff(index)
        self.keys, self.ids = keys[kept], ids[np.repeat(kept, length)]
        self.index = np.concatenate([[0], np.cumsum(length[kept])])
        self.again = np.zeros(len(self.keys), bool)  # met after the batch that brought it

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has."""
        plain = [k for k, w in enumerate(pieces) if MARK not in w] if self.mark is not None else []
        parts: list[np.ndarray | None] = [None] * len(pieces)
        groups = [plain[k:k + JOINED] for k in range(0, len(plain), JOINED)]
        texts = [f" {MARK} ".join([pieces[k] for k in group]) for group in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == len(group) - 1:
                at = [-1, *cuts.tolist(), len(ids)]
                for k, a, b in zip(group, at[:-1], at[1:], strict=True):
                    parts[k] = ids[a + 1:b]
        rest = [k for k, part in enumerate(parts) if part is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([pieces[k] for k in rest], add_special_tokens=False), strict=True):
            parts[k] = np.array(e.ids, np.uint32)
        return np.concatenate([*parts, np.zeros(0, np.uint32)]), np.fromiter(map(len, parts), np.int64, len(parts))

    def learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Merge new pieces, given in the order of their hashes, into the sorted arrays."""
        if self.keys.nbytes + self.ids.nbytes + self.index.nbytes > CACHE_BYTES:
            often = self.again if 2 * self.again.sum() < len(self.again) else np.zeros(len(self.again), bool)
            self.keep(often, self.keys, self.index, self.ids)
        ids, counts = self.encode_pieces(pieces)
        at = np.searchsorted(self.keys, hashes)
        length = np.insert(np.diff(self.index), at, counts)
        self.ids = np.insert(self.ids, np.repeat(self.index[at], counts), ids)
        self.index = np.concatenate([[0], np.cumsum(length)])
        self.keys, self.again = np.insert(self.keys, at, hashes), np.insert(self.again, at, False)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        return at, known

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a batch and the n + 1 offsets of the texts in them."""
        raw, offsets = text_bytes(column)
        odd = not self.by_words or b"<|" in raw.tobytes()
        if odd:
            parts = [self.whole(t or "") for t in column.to_pylist()]
            return np.concatenate([*parts, np.zeros(0, np.uint32)]), np.cumsum([0, *map(len, parts)])
        starts, ends, first = pieces_of(raw, offsets)
        hashes, example, back = np.unique(word_hashes(raw, starts, ends, LOWER), return_index=True, return_inverse=True)
        at, known = self._find(hashes)
        self.again[at[known]] = True
        if not known.all():
            new = np.flatnonzero(~known)
            self.learn(hashes[new], [raw[a:b].tobytes().lower().decode() for a, b in zip(starts[example[new]], ends[example[new]], strict=True)])
            at, known = self._find(hashes)
            if not known.all():  # some were forgotten to make room
                new = np.flatnonzero(~known)
                self.learn(hashes[new], [raw[a:b].tobytes().lower().decode() for a, b in zip(starts[example[new]], ends[example[new]], strict=True)])
                at, _ = self._find(hashes)
        place = at[back]
        length = np.diff(self.index)[place]
        ends_of = np.cumsum(length)
        which = np.repeat(self.index[place] - (ends_of - length), length) + np.arange(int(ends_of[-1]) if len(ends_of) else 0)
        return self.ids[which], np.concatenate([[0], ends_of])[first]


_ENCODERS: dict[str, WordEncoder] = {}


def _drops_white_space(path: str) -> bool:
    """Whether a tokenizer file lower-cases, drops white space, and splits letters from other signs."""
    import json

    with open(path, encoding="utf-8") as source:
        spec = json.load(source)
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = [s for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if s.get("type") == "Split"]
    pattern = splits[0]["pattern"].get("Regex", "") if splits else ""
    return (steps == ["NFC", "Replace", "Lowercase"] and splits[0].get("invert") is True
            and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"))


def encoder(path: str) -> WordEncoder:
    """The encoder of this worker; it lives as long as the worker does."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# -- operator ----------------------------------------------------------------------------------------------------------
def _binary(data: np.ndarray, index: np.ndarray) -> pa.Array:
    """Binary column from bytes and n + 1 offsets."""
    return pa.Array.from_buffers(pa.binary(), len(index) - 1, [None, pa.py_buffer(index.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _flat(column: pa.Array) -> np.ndarray:
    """All ids of a binary column of little-endian unsigned 32-bit integers, one document after the other."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view("<u4") if data is not None and len(column) else np.zeros(0, "<u4")


def tokenize(docs: DataFrame, vocabulary: str, end_id: int, order: str | None = None) -> DataFrame:
    """(doc_id, place, n, ids): the ids of each text with the end id, as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, index = encoder(vocabulary).batch(batch.column("text"))
            ids = np.insert(ids, index[1:], np.uint32(end_id)).astype("<u4")
            index = index + np.arange(len(index))
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("place").cast(pa.int64()),
                                   pa.array(np.diff(index), pa.int64()), _binary(ids.view(np.uint8), 4 * index)], names=["doc_id", "place", "n", "ids"])

    place = F.col(order) if order else F.col("doc_id")
    return docs.select("doc_id", place.cast("long").alias("place"), "text").mapInArrow(
        run, "doc_id long, place long, n long, ids binary")


def frequency_ranks(coded: DataFrame) -> np.ndarray:
    """Ids by falling corpus frequency (ties by id): entry r is the id of rank r. As long as the vocabulary in use."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in slices(batches, "ids"):
            part = np.bincount(_flat(batch.column("ids")))
            if len(part) > len(total):
                total = np.append(total, np.zeros(len(part) - len(total), np.int64))
            total[:len(part)] += part
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = coded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], np.uint32)


def write_files(coded: DataFrame, folder: str, codebook: np.ndarray) -> DataFrame:
    """Write all files of a corpus; gives (file, first, n_docs, n_ids) per file, ``first`` being the ids before it.

    Documents are dealt to ranges of (place, doc_id, hash of their ids), so not even rows of one place go to one task;
    the number of ranges follows the number of ids. One row a file is added up in order.
    """
    spark = coded.sparkSession
    files.make_folder(folder)
    files.write_file(f"{folder}/codebook.bin", [codebook.astype("<u4").tobytes()])
    ranges = int((coded.agg(F.sum("n")).first()[0] or 0) // RANGE_IDS) + 1
    size = max(int(codebook.max()) + 1 if len(codebook) else 1, 1)
    rank_of = np.zeros(size, np.uint32)
    rank_of[codebook] = np.arange(len(codebook), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # as long as the vocabulary

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            control, c_index, data, d_index = encode(shared.value[_flat(batch.column("ids"))], batch.column("n").to_numpy())
            yield pa.record_batch([*(batch.column(c) for c in ("place", "doc_id", "tie", "n")), _binary(control, c_index), _binary(data, d_index)],
                                  names=["place", "doc_id", "tie", "n", "control", "data"])

    schema = "place long, doc_id long, tie long, n long, control binary, data binary"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held = 0, 0
        open_docs: list[tuple] = []

        def close() -> pa.RecordBatch:
            nonlocal part, held
            doc, n = [d[0] for d in open_docs], np.array([d[1] for d in open_docs], np.int64)
            name = f"{folder}/{TaskContext.get().partitionId():08d}-{part:06d}.rvb"
            files.write_file(name, [
                struct.pack(HEAD, MAGIC, len(doc), int(n.sum())), np.array([d or 0 for d in doc], "<i8").tobytes(),
                np.array([d is None for d in doc], "u1").tobytes(), n.astype("<u4").tobytes(), *(d[2] for d in open_docs), *(d[3] for d in open_docs)])
            part, held = part + 1, 0
            open_docs.clear()
            return pa.record_batch([pa.array([name]), pa.array([len(doc)], pa.int64()), pa.array([int(n.sum())], pa.int64())],
                                   names=["file", "n_docs", "n_ids"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "control", "data")), strict=True):
                if held >= FILE_IDS:
                    yield close()
                open_docs.append(row)
                held += row[1]
        if open_docs:
            yield close()

    order = [F.col(c).asc_nulls_first() for c in ("place", "doc_id", "tie")]
    packed = coded.withColumn("tie", F.xxhash64("ids")).mapInArrow(pack, schema)
    dealt = packed.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "n", "control", "data")
    written = common.stored(dealt.mapInArrow(write, "file string, n_docs long, n_ids long"), f"{folder}/written")
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    listed = common.stored(written.select("file", F.coalesce(before, F.lit(0).cast("long")).alias("first"), "n_docs", "n_ids"), f"{folder}/files")
    common.remove_folder(spark, f"{folder}/written")
    return listed


def read_files(listed: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    many = -(-listed.count() // READ_FILES) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebook = np.frombuffer(files.read_file(f"{folder}/codebook.bin"), "<u4")
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                yield _file_rows(files.read_file(name), codebook, first)

    return listed.select("file", "first").repartition(many, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def file_ids(blob: bytes, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, null flags, counts and all ids of one file."""
    magic, docs, ids = struct.unpack_from(HEAD, blob)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize(HEAD)
    doc = np.frombuffer(blob, "<i8", docs, at)
    null = np.frombuffer(blob, "u1", docs, at + 8 * docs)
    counts = np.frombuffer(blob, "<u4", docs, at + 9 * docs).astype(np.int64)
    at += 13 * docs
    n_control = int((-(-counts // 4)).sum())
    control = np.frombuffer(blob, np.uint8, n_control, at)
    ranks = decode(control, counts, np.frombuffer(blob, np.uint8, offset=at + n_control))
    if len(ranks) != ids:
        raise ValueError("a token file is damaged")
    return doc, null.astype(bool), counts, codebook[ranks]


def _file_rows(blob: bytes, codebook: np.ndarray, first: int) -> pa.RecordBatch:
    doc, null, counts, ids = file_ids(blob, codebook)
    ends = np.cumsum(counts)
    raw = ids.astype("<u4")
    crcs = [common.crc(raw[a:b].tobytes()) for a, b in zip(ends - counts, ends, strict=True)]
    return pa.record_batch([pa.array(doc, mask=null), pa.array(first + ends - counts), pa.array(counts),
                            pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


RESULT = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])


def token_files(docs: DataFrame, vocabulary: str, *, end_id: int = 1, order: str | None = None, folder: str | None = None) -> DataFrame:
    """Encode, write and read back a corpus: one row (doc_id, start, n_tokens, ids_crc32) per row of ``docs``.

    Documents are written in ascending doc_id order, or by the integer column ``order``; a null id comes first. Null
    and empty texts consist of the end id. Repeated rows are written as often as they occur. An empty table gives a
    codebook and no rows. Columns beside doc_id and text are ignored.
    """
    spark = docs.sparkSession
    folder = folder or common.run_folder(spark, "tokens")
    coded = common.stored(tokenize(docs, vocabulary, end_id, order), f"{folder}-ids", "zstd")
    listed = write_files(coded, folder, frequency_ranks(coded))
    common.remove_folder(spark, f"{folder}-ids")
    return read_files(listed, folder)
