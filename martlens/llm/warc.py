"""WARC archives with a two-level capture index.

Records are written in the order of the input, each as its own gzip member. Of equal payloads of at least
``MIN_SHARED`` bytes, the page with the smallest id holds the payload and the others are revisit records.

The index is sorted by reversed-host URL key (``com,example,www)/path``). Each segment file holds blocks of ``BLOCK``
lines, compressed one by one; next to it lies a sparse directory with the first key, offset and length of each block.
A look-up searches the segments' first keys, then one segment's directory, by halving, and reads only the byte ranges
of the blocks that can hold the key, then those of the records.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm import common, files
from martlens.llm.common import slices

MIN_SHARED = 100
BLOCK = 3000
FILE_BYTES = 64 << 20

#: Pages carry no capture time; the format asks for one.
NO_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- keys --------------------------------------------------------------------------------------------------------------
def url_key(url: str | None) -> str:
    """Reversed host, port unless usual, path and query; without scheme, user and fragment. Null gives the empty key."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.strip().replace("\n", "%0A").replace("\r", "%0D")
    name = ",".join(reversed(host.split("."))) if host else ""
    usual = port is None or (parts.scheme, port) in (("http", 80), ("https", 443))
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (name + ("" if usual else f":{port}") + ")" + rest).replace("\n", "%0A").replace("\r", "%0D")


# -- records -----------------------------------------------------------------------------------------------------------
def record_uri(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _record(headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_uri(page_id, digest)),
               ("WARC-Date", NO_DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if refers_to is None:
        return _record(headers, http + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(refers_to, digest)),
                ("X-Refers-To-Page-Id", str(refers_to)), ("X-Payload-Length", str(len(payload)))]
    return _record(headers, http)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[:int(headers["Content-Length"])]
    if len(block) != int(headers["Content-Length"]):
        raise ValueError("a WARC record is cut short")
    return headers, block


def _gz(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# -- writing -----------------------------------------------------------------------------------------------------------
ENTRY = "url_key string, page_id long, file string, offset long, length long"


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is the smallest page with the same payload, null for itself."""
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    # One row for each payload that occurs twice: the pages are counted map-side.
    shared = pages.where(F.octet_length(payload) >= MIN_SHARED).groupBy(F.sha2(payload, 256).alias("shared_digest")).agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keyed.join(shared, F.col("digest") == F.col("shared_digest"), "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all records; gives an index entry (url_key, page_id, file, offset, length) for each."""
    files.make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem, part = f"{folder}/{task.partitionId():05d}-{task.taskAttemptId()}", 0
        parts: list[bytes] = []
        rows: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"{stem}-{part:04d}.warc.gz"
            files.write_file(name, parts)
            columns = list(zip(*[(key, page, name, at, n) for key, page, at, n in rows], strict=True))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                   names=["url_key", "page_id", "file", "offset", "length"])

        for batch in slices(batches, "html"):
            for page, url, html, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                if not parts:
                    parts.append(_gz(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_uri(None, f"{stem}-{part}")),
                                              ("WARC-Date", NO_DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                    size = len(parts[0])
                data = _gz(page_record(page, url, html.encode(), digest, refers_to))
                rows.append((url_key(url), page, size, len(data)))
                parts.append(data)
                size += len(data)
                if size >= FILE_BYTES:
                    yield close()
                    parts, rows, part = [], [], part + 1
        if rows:
            yield close()

    return common.stored(with_revisits(pages).mapInArrow(write, ENTRY), f"{folder}/entries")


DIRECTORY = "segment string, first_key string, last_key string, offset long, length long, n long"


def write_index(entries: DataFrame, folder: str) -> DataFrame:
    """Sort the entries into segments of compressed blocks; gives the sparse directory, a row per block."""
    files.make_folder(folder)
    parts = max(entries.count() // (50 * BLOCK), 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/{task.partitionId():05d}-{task.taskAttemptId()}.idx"
        blocks: list[bytes] = []
        rows: list[tuple] = []
        lines: list[str] = []
        keys: list[str] = []
        at = 0

        def close() -> None:
            nonlocal at
            block = zlib.compress("\n".join(lines).encode())
            rows.append((name, keys[0], keys[-1], at, len(block), len(lines)))
            blocks.append(block)
            at += len(block)
            lines.clear()
            keys.clear()

        for batch in batches:
            for row in batch.to_pylist():
                keys.append(row["url_key"])
                lines.append(json.dumps([row[c] for c in ("url_key", "page_id", "file", "offset", "length")]))
                if len(lines) >= BLOCK:
                    close()
        if lines:
            close()
        if rows:
            files.write_file(name, blocks)
            files.write_file(f"{name}.dir", [json.dumps([r[1:] for r in rows]).encode()])
            columns = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["segment", "first_key", "last_key", "offset", "length", "n"])

    order = ["url_key", "page_id", "file", "offset"]
    ordered = entries.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return common.stored(ordered.mapInArrow(write, DIRECTORY), f"{folder}/directory")


# -- reading -----------------------------------------------------------------------------------------------------------
def _entry_batch(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                           names=["url_key", "page_id", "file", "offset", "length"])


def read_block(segment: str, offset: int, length: int) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(files.read_range(segment, offset, length)).decode().split("\n")]


def read_index(directory: DataFrame) -> DataFrame:
    """All index entries, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, offset, length in zip(*(batch.column(c).to_pylist() for c in ("segment", "offset", "length")), strict=True):
                yield _entry_batch(read_block(segment, offset, length))

    return directory.select("segment", "offset", "length").mapInArrow(run, ENTRY)


def lookup(urls: DataFrame, directory: DataFrame) -> DataFrame:
    """Index entries (with the asked ``url``) whose key equals that of a row of ``urls`` (url).

    The first and last key of each segment go to the driver, one pair per segment. Every question is sent to the segments
    that can hold its key; each task then searches the segment's directory and reads the blocks in question.
    """
    spans = sorted((r.low, r.high, r.segment) for r in directory.groupBy("segment").agg(
        F.min("first_key").alias("low"), F.max("last_key").alias("high")).collect())
    highs = [s[1] for s in spans]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url in batch.column("url").to_pylist():
                key = url_key(url)
                at = bisect.bisect_left(highs, key)
                while at < len(spans) and spans[at][0] <= key:
                    out.append((url, key, spans[at][2]))
                    at += 1
            columns = list(zip(*out, strict=True)) if out else [()] * 3
            yield pa.record_batch([pa.array(c, pa.string()) for c in columns], names=["url", "key", "segment"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, blocks, lasts, held, held_at = None, [], [], [], None
        for batch in batches:
            rows = []
            for url, key, name in zip(*(batch.column(c).to_pylist() for c in ("url", "key", "segment")), strict=True):
                if name != segment:
                    segment, blocks, held_at = name, json.loads(files.read_file(f"{name}.dir")), None
                    lasts = [b[1] for b in blocks]
                at = bisect.bisect_left(lasts, key)
                while at < len(blocks) and blocks[at][0] <= key:
                    if held_at != at:
                        held, held_at = read_block(segment, blocks[at][2], blocks[at][3]), at
                    first = bisect.bisect_left(held, key, key=lambda e: e[0])
                    last = bisect.bisect_right(held, key, key=lambda e: e[0])
                    rows += [[url, *e] for e in held[first:last]]
                    at += 1
            inner = _entry_batch([r[1:] for r in rows])
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), *inner.columns], names=["url", *inner.schema.names])

    sent = urls.select("url").distinct().mapInArrow(send, "url string, key string, segment string")
    # By ranges, so that a block is read by one or two tasks, not by all.
    return sent.repartitionByRange("segment", "key").sortWithinPartitions("segment", "key").mapInArrow(find, f"url string, {ENTRY}")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(entries: DataFrame) -> DataFrame:
    """The records that ``entries`` (file, offset, length) point to; the payload of a response is digested anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ranges = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)
            for data in files.read_ranges(ranges):
                headers, block = parse_record(zlib.decompress(data, 31))
                payload = block.partition(b"\r\n\r\n")[2]
                page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                if headers["WARC-Type"] == "response":
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError("a payload does not fit its digest")
                    size = len(payload)
                else:
                    size = int(headers["X-Payload-Length"])
                rows.append((int(page) if page else None, headers["WARC-Target-URI"] or None, size, digest, headers["WARC-Type"], int(refers) if refers else None))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    many = max(entries.select("file").distinct().count(), 1)
    return entries.select("file", "offset", "length").repartition(many, "file").sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and their index, look up all their URLs and read the found records back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Null html is an empty payload. A
    page without an id is a revisit of an equal payload that has one, and a response otherwise; rows that repeat the
    smallest id of a payload are all responses. An empty table gives no files and no rows; further columns are ignored.
    """
    folder = folder or common.run_folder(pages.sparkSession, "warc")
    entries = write_archives(pages.select("page_id", "url", "html"), folder)
    directory = write_index(entries, f"{folder}/index")
    # URLs that differ in scheme or fragment share a key, and each finds the entries of all.
    found = lookup(pages.select("url"), directory).select("file", "offset", "length").distinct()
    return read_records(common.stored(found, f"{folder}/found")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
