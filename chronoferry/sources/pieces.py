"""Text files in pieces of bytes, each read by a task of its own.

A line belongs to the piece that its line end lies in. So pieces may begin and end anywhere, no line is lost
or read twice, and a last line without an end belongs to no piece until it gets one. Files are opened through
pyarrow's file systems, which know local, HDFS and object-store addresses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql.datasource import InputPartition

PIECE_BYTES = 64 << 20
# Bytes read at once.
BLOCK = 4 << 20
_LOOK_BACK = 64 << 10


@dataclass
class Piece(InputPartition):
    """The lines of a file that end in `start <= byte < end`; with `open_end` also what stands after the last one."""

    path: str
    start: int
    end: int
    open_end: bool = False


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it."""
    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def sizes(path: str, pattern: str = "*") -> dict[str, int]:
    """Sizes of the files at or below a path whose names match; hidden names are left out, as Spark does."""
    system, root = open_folder(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return {root: info.size}
    if info.type == fs.FileType.NotFound:
        return {}
    found = {}
    for entry in system.get_file_info(fs.FileSelector(root, recursive=True)):
        inside = entry.path[len(root.rstrip("/")) + 1 :]
        hidden = any(part.startswith(("_", ".")) for part in inside.split("/"))
        if entry.type == fs.FileType.File and not hidden and fnmatch(entry.base_name, pattern):
            found[entry.path] = entry.size
    return found


def cut(path: str, start: int, end: int, open_end: bool = False, piece: int = PIECE_BYTES) -> list[Piece]:
    """A stretch of a file as pieces of about equal size."""
    edges = [*range(start, end, piece), end]
    return [Piece(path, a, b, open_end and b == end) for a, b in zip(edges, edges[1:])]


def read_lines(system: fs.FileSystem, piece: Piece) -> Iterator[list[bytes]]:
    """The lines of a piece without their ends, some at a time."""
    with system.open_input_file(piece.path) as file:
        at = _line_start(file, piece.start)
        file.seek(at)
        held = b""
        while at < piece.end:
            block = file.read(min(BLOCK, piece.end - at))
            if not block:
                break  # the file has become shorter meanwhile
            at += len(block)
            *lines, held = (held + block).split(b"\n")
            if lines:
                yield [line.removesuffix(b"\r") for line in lines]
        if piece.open_end and held:
            yield [held.removesuffix(b"\r")]


def _line_start(file, at: int) -> int:
    """Where the line begins that goes on at a byte."""
    while at > 0:
        before = max(0, at - _LOOK_BACK)
        file.seek(before)
        found = file.read(at - before).rfind(b"\n")
        if found >= 0:
            return before + found + 1
        at = before
    return 0
