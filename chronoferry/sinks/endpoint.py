"""The line-protocol endpoint as a Spark data source, for batch and streaming writes.

Every task opens one connection and sends its lines in bodies of `batch_size`.
A body counts as written once the target has answered. A task that fails is run
again by Spark and sends its lines again: delivery is at least once, and harmless
because equal points overwrite each other in the target.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from chronoferry.config import DEFAULT_BATCH_SIZE
from chronoferry.sinks.transport import Connection, RetryPolicy, transport_factory

FORMAT = "lineprotocol"


@dataclass
class Sent(WriterCommitMessage):
    lines: int
    bodies: int


def bodies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, bytes]]:
    """Arrow batches of one text column, regrouped into bodies of `size` lines and their numbers of lines.

    Lines are joined column-wise; no line is a Python object.
    """
    held = pa.array([], pa.binary())
    for batch in batches:
        held = pa.concat_arrays([held, batch.column(0).cast(pa.binary())])
        full = len(held) // size * size
        yield from ((size, body) for body in _joined(held[:full], size))
        held = held[full:]
    yield from ((len(held), body) for body in _joined(held, max(len(held), 1)))


def _joined(lines: pa.Array, size: int) -> Iterator[bytes]:
    groups = pa.ListArray.from_arrays(pa.array(range(0, len(lines) + 1, size), pa.int32()), lines)
    return (body.as_py() for body in pc.binary_join(groups, b"\n"))


class _Sender:
    """What both writers do in a task."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def write(self, iterator: Iterator) -> Sent:
        size = int(self.options.get("batch_size", DEFAULT_BATCH_SIZE))
        connection = Connection(transport_factory(self.options), RetryPolicy.from_options(self.options))
        connection.connect()
        lines = count = 0
        try:
            for held, body in bodies(iterator, size):
                connection.send(body)
                lines, count = lines + held, count + 1
        finally:
            connection.close()
        return Sent(lines, count)


class LineWriter(_Sender, DataSourceArrowWriter):
    pass


class LineStreamWriter(_Sender, DataSourceStreamArrowWriter):
    pass


class LineEndpoint(DataSource):
    """`df.write.format("lineprotocol")` for a frame with the single text column `line`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> LineWriter:
        _check(schema)
        return LineWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> LineStreamWriter:
        _check(schema)
        return LineStreamWriter(self.options)


def _check(schema) -> None:
    if [f.dataType.simpleString() for f in schema.fields] != ["string"]:
        raise ValueError(f"expected one text column, got {schema.simpleString()}")
