"""Files in the shared folder, written and read by tasks.

A file is written under a name of its attempt and then renamed, so a repeated or speculative task leaves one whole
file with the same content.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else uri.replace("file:", "file://", 1))


def make_folder(uri: str) -> None:
    where, path = _open(uri)
    where.create_dir(path, recursive=True)


def write_file(uri: str, parts: list[bytes]) -> int:
    """Write ``parts`` one after the other; gives the size."""
    where, path = _open(uri)
    own = f"{path}.{uuid.uuid4().hex}.tmp"
    size = 0
    with where.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    where.move(own, path)
    return size


def read_file(uri: str) -> bytes:
    where, path = _open(uri)
    with where.open_input_stream(path) as source:
        return source.read()


def read_range(uri: str, offset: int, length: int) -> bytes:
    where, path = _open(uri)
    with where.open_input_file(path) as source:
        return source.read_at(length, offset)


def read_ranges(ranges: Iterable[tuple[str, int, int]]) -> Iterator[bytes]:
    """The bytes of (file, offset, length) one after the other; neighbours in one file share the open file."""
    name, source = None, None
    try:
        for uri, offset, length in ranges:
            if uri != name:
                if source:
                    source.close()
                where, path = _open(uri)
                name, source = uri, where.open_input_file(path)
            yield source.read_at(length, offset)
    finally:
        if source:
            source.close()
