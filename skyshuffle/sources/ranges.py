"""Byte ranges of local files, HTTP resources and files of other file systems."""

from __future__ import annotations

import urllib.request
from collections import OrderedDict

from pyarrow import fs

BLOCK_BYTES, BLOCKS = 256 * 1024, 128


def is_url(source: str) -> bool:
    return source.lower().startswith(("http://", "https://"))


def changed(source: str) -> str:
    """A mark that a file's rewriting changes; empty for HTTP, which tells of none, and for what is not there."""
    if is_url(source):
        return ""
    system, path = _located(source)
    return str(system.get_file_info(path).mtime_ns or "")


def _located(source: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, gs ...) or a local path, and the path there."""
    return fs.FileSystem.from_uri(source) if "://" in source else (fs.LocalFileSystem(), source)


class Ranges:
    """read(offset, size) of a path or URI. HTTP is read in aligned blocks, of which the latest are kept."""

    def __init__(self, source: str):
        self.source = source
        self._file = None
        if not is_url(source):
            system, path = _located(source)
            self._file = system.open_input_file(path)
        self._blocks: OrderedDict[int, bytes] = OrderedDict()

    def _block(self, k: int) -> bytes:
        if k not in self._blocks:
            ask = urllib.request.Request(self.source, headers={"Range": f"bytes={k * BLOCK_BYTES}-{(k + 1) * BLOCK_BYTES - 1}"})
            with urllib.request.urlopen(ask) as reply:
                if reply.status != 206:
                    raise ValueError(f"{self.source} does not serve ranges: status {reply.status}")
                self._blocks[k] = reply.read()
            while len(self._blocks) > BLOCKS:
                self._blocks.popitem(last=False)
        self._blocks.move_to_end(k)
        return self._blocks[k]

    def read(self, offset: int, size: int) -> bytes:
        if offset < 0 or size < 0:
            raise ValueError("A range is bounded: offset and size must be >= 0")
        if self._file is not None:
            self._file.seek(offset)
            return self._file.read(size)
        first, last = offset // BLOCK_BYTES, (offset + size - 1) // BLOCK_BYTES
        data = b"".join(self._block(k) for k in range(first, last + 1))
        return data[offset - first * BLOCK_BYTES :][:size]

    def close(self) -> None:
        if self._file is not None:
            self._file.close()

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
