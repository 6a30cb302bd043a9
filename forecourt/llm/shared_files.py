"""Binary files in the shared folder, written and read by tasks.

Paths are URIs that pyarrow understands (file, s3, gs, hdfs, ...) or absolute local paths. A task
writes under a name of its own and its rows tell the name; only rows of tasks that Spark commits
are kept, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

from pyarrow import fs

GAP_BYTES = 64 * 1024
READ_BYTES = 8 * 1024 * 1024


@lru_cache(maxsize=16)
def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def new_name(task: int, suffix: str) -> str:
    return f"{task:06d}-{uuid.uuid4().hex}{suffix}"


class Appender:
    """A file that a task writes from start to end; ``offset`` is where the next piece goes."""

    def __init__(self, folder: str, name: str):
        system, root = _opened(folder)
        system.create_dir(root, recursive=True)
        self._stream = system.open_output_stream(f"{root}/{name}", compression=None)
        self.offset = 0

    def write(self, data: bytes) -> tuple[int, int]:
        """Offset and length of the piece."""
        start = self.offset
        self._stream.write(data)
        self.offset += len(data)
        return start, len(data)

    def close(self) -> None:
        self._stream.close()


def write_file(folder: str, name: str, data: bytes) -> None:
    file = Appender(folder, name)
    file.write(data)
    file.close()


def read_file(folder: str, name: str) -> bytes:
    system, root = _opened(folder)
    with system.open_input_file(f"{root}/{name}") as file:
        return file.read()


def read_ranges(folder: str, ranges: Iterable[tuple[str, int, int]]) -> Iterator[bytes]:
    """The bytes of (file, offset, length) in the given order.

    Ranges that follow each other in one file, with gaps of at most 64 KB, are read at once, up to 8 MB
    or one range.
    """
    system, root = _opened(folder)
    name, file = None, None
    try:
        for group in _coalesced(ranges):
            if group[0][0] != name:
                if file:
                    file.close()
                name = group[0][0]
                file = system.open_input_file(f"{root}/{name}")
            start, end = group[0][1], max(offset + length for _, offset, length in group)
            data = file.read_at(end - start, start)
            for _, offset, length in group:
                yield data[offset - start : offset - start + length]
    finally:
        if file:
            file.close()


def _coalesced(ranges: Iterable[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    group: list[tuple[str, int, int]] = []
    for name, offset, length in ranges:
        if group:
            last_name, last_offset, last_length = group[-1]
            follows = name == last_name and 0 <= offset - (last_offset + last_length) <= GAP_BYTES
            if not follows or offset + length - group[0][1] > READ_BYTES:
                yield group
                group = []
        group.append((name, offset, length))
    if group:
        yield group
