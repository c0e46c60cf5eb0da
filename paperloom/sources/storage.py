"""File access from inside tasks: local paths, and any URI pyarrow.fs understands."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

from pyarrow import fs as pafs


# Files being written; never listed, gone once published.
_TEMPORARY = ".paperloom-part-"


class Entry(NamedTuple):
    name: str
    is_dir: bool
    size: int
    modified_us: int


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a location."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def list_dir(uri: str) -> Iterator[Entry]:
    """Every file and folder directly below `uri`, hidden and empty ones included."""
    fs, path = resolve(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        found = _local_entries(path)
    else:
        found = (
            Entry(i.base_name, i.type == pafs.FileType.Directory, i.size or 0, (i.mtime_ns or 0) // 1000)
            for i in fs.get_file_info(pafs.FileSelector(path))
        )
    return (entry for entry in found if not entry.name.startswith(_TEMPORARY))


def is_empty(uri: str) -> bool:
    """Is there nothing at `uri`, or only an empty folder?"""
    try:
        return next(iter(list_dir(uri)), None) is None
    except (FileNotFoundError, NotADirectoryError):
        return not _exists(uri)


def _exists(uri: str) -> bool:
    fs, path = resolve(uri)
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _local_entries(path: str) -> Iterator[Entry]:
    with os.scandir(path) as entries:
        for e in entries:
            try:
                if e.is_dir(follow_symlinks=False):
                    yield Entry(e.name, True, 0, 0)
                elif e.is_file():
                    stat = e.stat()
                    yield Entry(e.name, False, stat.st_size, stat.st_mtime_ns // 1000)
            except FileNotFoundError:
                continue  # removed while listing


def read_range(uri: str, offset: int, length: int) -> bytes:
    fs, path = resolve(uri)
    with fs.open_input_file(path) as handle:
        handle.seek(offset)
        found = handle.read(length)
    if len(found) != length:
        raise OSError(f"{uri}: {len(found)} of {length} bytes at {offset}")
    return found


def read_from(uri: str, offset: int = 0, piece_bytes: int = 8 << 20) -> Iterator[bytes]:
    """A file from `offset` on in pieces, so that memory does not grow with its size."""
    fs, path = resolve(uri)
    with fs.open_input_file(path) as handle:
        handle.seek(offset)
        while piece := handle.read(piece_bytes):
            yield piece


def file_size(uri: str) -> int | None:
    """Size of a file; null for a folder."""
    fs, path = resolve(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    return info.size if info.is_file else None


class AtomicFile:
    """Write under a hidden temporary name; appear under the final name on success.

    A retried or duplicated task replaces the file with identical content, and a
    lost one leaves only a hidden temporary file that no reader looks at.
    """

    def __init__(self, uri: str):
        self.fs, self.path = resolve(uri)
        parent, _, name = self.path.rpartition("/")
        self.fs.create_dir(parent, recursive=True)
        self.temporary = f"{parent}/{_TEMPORARY}{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.temporary)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def publish(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.path)

    def discard(self) -> None:
        self.stream.close()
        self.fs.delete_file(self.temporary)
