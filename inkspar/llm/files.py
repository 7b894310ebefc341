"""Files of our own formats in the shared folder, written whole or not at all by tasks that may be tried again."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI such as file:///x or hdfs://host/x; a bare path is a local one."""
    return fs.FileSystem.from_uri(uri)


@contextmanager
def replacing(uri: str, attempt: int) -> Iterator:
    """A stream whose content gets the name of uri only when all is written; a second attempt replaces the first's equal file."""
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{attempt}.part"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, path)
