"""Binary files in the shared folder, written and read by tasks.

Locations are URIs of any file system that ``pyarrow.fs`` opens (a mounted
shared folder, an object store, HDFS). A task writes under a name of its own
attempt and hands the name on with its rows, so files of failed or repeated
attempts are never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyarrow import fs


def opened(location: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", location))


class Writer:
    """One new file ``<folder>/<label>-<unique>.<suffix>``; ``at`` is the next byte's offset."""

    def __init__(self, folder: str, label: str, suffix: str):
        self.location = f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex[:16]}.{suffix}"
        system, path = opened(self.location)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self._out, self.at = system.open_output_stream(path, compression=None), 0

    def write(self, data: bytes) -> int:
        """Append; returns the offset at which ``data`` starts."""
        start = self.at
        self._out.write(data)
        self.at += len(data)
        return start

    def close(self) -> None:
        self._out.close()


class Reader:
    """Range reads of one file; near ranges are fetched together."""

    def __init__(self, location: str):
        system, path = opened(location)
        self._file = system.open_input_file(path)
        self.size = self._file.size()

    def read(self, offset: int, length: int) -> bytes:
        return self._file.read_at(length, offset)

    def ranges(self, spans: list[tuple[int, int]], gap: int = 64 << 10, most: int = 8 << 20) -> Iterator[bytes]:
        """The bytes of ascending (offset, length) spans; spans less than ``gap`` apart share
        a request of up to ``most`` bytes."""
        i = 0
        while i < len(spans):
            start, end, j = spans[i][0], sum(spans[i]), i + 1
            while j < len(spans) and spans[j][0] - end <= gap and sum(spans[j]) - start <= most:
                end, j = max(end, sum(spans[j])), j + 1
            block = self.read(start, end - start)
            for offset, length in spans[i:j]:
                yield block[offset - start:offset - start + length]
            i = j

    def close(self) -> None:
        self._file.close()
