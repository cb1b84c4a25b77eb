"""Binary files that tasks write below the shared folder and read back by byte range."""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return fs.FileSystem.from_uri(path)


def attempt_name() -> str:
    """Tells attempts at one partition apart: a file belongs to the attempt whose row names it."""
    c = TaskContext.get()
    return f"{c.partitionId():06d}-{c.taskAttemptId()}" if c else "000000-0"


def partition_number() -> int:
    c = TaskContext.get()
    return c.partitionId() if c else 0


def write_file(folder: str, name: str, parts: list[bytes]) -> str:
    """Write one file; returns its full path."""
    system, at = open_fs(folder)
    system.create_dir(at, recursive=True)
    # the name of a file must not make the library compress it
    with system.open_output_stream(f"{at}/{name}", compression=None) as f:
        for x in parts:
            f.write(x)
    return f"{folder}/{name}"
