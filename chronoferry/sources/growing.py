"""Log files that are still being written, as a stream of whole lines.

The offset of the stream is the size of each file. A batch reads what has been added since the last one: every
line once, when its line end is there. A file that became shorter is read from its start again; one that was
renamed is a new file, so leave out the names that rolled files get (`pattern`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader

from chronoferry.config import pickle_whole, ship_package
from chronoferry.sources.pieces import Piece, cut, open_folder, read_lines, sizes

FORMAT = "growinglines"


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._path = options["path"]
        self._pattern = options.get("pattern", "*")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return sizes(self._path, self._pattern)

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for path, size in sorted(end.items()):
            seen = start.get(path, 0)
            pieces += cut(path, seen if seen <= size else 0, size)
        return pieces

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no pieces
            return
        system, _ = open_folder(self._path)
        for lines in read_lines(system, partition):
            values = [line.decode("utf-8", "replace") for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(lines)), pa.array(values)], ["file", "value"])


class GrowingLines(DataSource):
    """`spark.readStream.format("growinglines").load(folder)`: columns `file, value`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, value string"

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(dict(self.options))


def growing_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """`file, value` of every whole line of the files below a path, as a stream."""
    ship_package(spark)
    pickle_whole(__name__, "chronoferry.sources.pieces")
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("pattern", pattern).load(path)
