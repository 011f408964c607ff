"""Files of line protocol, read back as a table.

A time filter on `ts_ms` reaches the reader: the time is the end of a line, so lines outside are dropped
before anything else of them is read. Text columns are tags, whole numbers and doubles are fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    LessThan,
    LessThanOrEqual,
)

from chronoferry.config import ship_package
from chronoferry.functions.line import escape_text
from chronoferry.operators.points import PointLayout
from chronoferry.sources.pieces import Piece, cut, open_folder, read_lines, sizes

FORMAT = "linefiles"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
LEAST, GREATEST = -(2**63), 2**63 - 1

# Parts between separators that no odd run of backslashes stands before.
_PARTS = {sep: re.compile(rf"((?:\\.|[^\\{sep}])+)(?:{sep}|$)", re.S) for sep in ", ="}
_RUN = re.compile(r"(\\+)([,= ]|$)")


def split_line(line: str) -> tuple[str, dict[str, str], dict[str, str], int]:
    """Measurement, tags, fields as text, and time of a line; names keep their escapes, tag values don't."""
    if "\\" in line:
        head, body, ts = (m.group(1) for m in _PARTS[" "].finditer(line))
        tags = [_pair(m.group(1)) for m in _PARTS[","].finditer(head)]
        fields = dict(_pair(m.group(1)) for m in _PARTS[","].finditer(body))
        return _plain(tags[0][0]), {k: _plain(v) for k, v in tags[1:]}, fields, int(ts)
    head, body, ts = line.split(" ")
    measurement, *tags = head.split(",")
    return measurement, dict(t.split("=") for t in tags), dict(f.split("=") for f in body.split(",")), int(ts)


def _pair(text: str) -> tuple[str, str]:
    name, *value = (m.group(1) for m in _PARTS["="].finditer(text))
    return name, value[0] if value else ""


def _plain(text: str) -> str:
    return _RUN.sub(lambda m: "\\" * (len(m.group(1)) // 2) + m.group(2), text)


class LineReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self._path, self._pattern = options["path"], options.get("pattern", "*")
        self._schema = schema
        self._from, self._until = LEAST, GREATEST  # both inclusive

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != ("ts_ms",) or not isinstance(
                f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
            ):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self._from = max(self._from, f.value + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self._until = min(self._until, f.value - isinstance(f, LessThan))

    def partitions(self) -> list[Piece]:
        if self._from > self._until:
            return []
        found = sorted(sizes(self._path, self._pattern).items())
        packed = [path for path, _ in found if path.endswith((".gz", ".bz2", ".zst"))]
        if packed:
            raise ValueError(f"compressed files have no places to cut at: {packed[0]}")
        return [piece for path, size in found for piece in cut(path, 0, size, open_end=True)]

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no pieces
            return
        system, _ = open_folder(self._path)
        for lines in read_lines(system, partition):
            wanted = [line for line in lines if line and self._inside(line)]
            if wanted:
                yield self._batch([split_line(line.decode("utf-8", "replace")) for line in wanted])

    def _inside(self, line: bytes) -> bool:
        return self._from <= int(line[line.rfind(b" ") + 1 :]) <= self._until

    def _batch(self, rows: list[tuple[str, dict[str, str], dict[str, str], int]]) -> pa.RecordBatch:
        columns = []
        for f in self._schema.fields:
            name = escape_text(f.name)
            if f.name == "measurement":
                columns.append(pa.array([r[0] for r in rows], pa.string()))
            elif f.name == "ts_ms":
                columns.append(pa.array([r[3] for r in rows], pa.int64()))
            elif isinstance(f.dataType, T.StringType):
                columns.append(pa.array([r[1].get(name) for r in rows], pa.string()))
            elif isinstance(f.dataType, T.LongType):
                texts = (r[2].get(name) for r in rows)
                columns.append(pa.array([None if t is None else int(t.removesuffix("i")) for t in texts], pa.int64()))
            else:
                texts = (r[2].get(name) for r in rows)
                columns.append(pa.array([None if t is None else float(t) for t in texts], pa.float64()))
        return pa.RecordBatch.from_arrays(columns, names=self._schema.fieldNames())


class LineFiles(DataSource):
    """`spark.read.format("linefiles").schema(...).load(folder)`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("lines have no schema of their own: name the columns")

    def reader(self, schema: T.StructType) -> LineReader:
        for f in schema.fields:
            if not isinstance(f.dataType, (T.StringType, T.LongType, T.DoubleType)):
                raise ValueError(f"column {f.name!r}: tags are string, fields bigint or double")
        return LineReader(dict(self.options), schema)


def scan_lines(spark: SparkSession, path: str, layout: PointLayout, pattern: str = "*") -> DataFrame:
    """`measurement, ts_ms` and a column for each tag and field of the layout, from files of lines below a path.

    Filters reach the reader only if the session lets them: this turns `spark.sql.python.filterPushdown.enabled` on.
    """
    ship_package(spark)
    spark.dataSource.register(LineFiles)
    spark.conf.set(PUSHDOWN_CONF, "true")
    kinds = {**dict.fromkeys(layout.tags, T.StringType()), **dict.fromkeys(layout.i64, T.LongType())}
    kinds |= dict.fromkeys(layout.f64, T.DoubleType())
    fields = [T.StructField("measurement", T.StringType()), T.StructField("ts_ms", T.LongType())]
    fields += [T.StructField(name, kinds[name]) for name in (*layout.tags, *layout.fields)]
    return spark.read.format(FORMAT).schema(T.StructType(fields)).option("pattern", pattern).load(path)
