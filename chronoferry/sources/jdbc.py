"""A JDBC table, read in parallel by time slice.

Each slice becomes the predicate of one Spark partition, so a task opens one
connection, asks for its slice only, and streams it with the fetch size; a task
that fails reads its slice again. The range itself is found by the database,
once, on behalf of the driver.

`partitionColumn`/`lowerBound`/`upperBound` would set strides but not restrict
the rows, which is why predicates are used.

Names and instants are written as Spark's own dialect for the address writes them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoferry.config import DEFAULT_BATCH_SIZE, DEFAULT_SLICES, DEFAULT_TIME_COLUMN
from chronoferry.functions.timestamps import epoch_us
from chronoferry.operators.ranges import TimeRange, parse_bounds
from chronoferry.operators.slices import even_slices, slice_ranges
from chronoferry.sources.endpoint import native_url

# For even slices: how much finer the counted slices are, and how many one statement counts.
FINER = 32
COUNTS_PER_STATEMENT = 128

_NAME = r"[A-Za-z_][A-Za-z0-9_$]*"
_TABLE = re.compile(rf"{_NAME}(\.{_NAME}){{0,2}}")


@dataclass(frozen=True)
class JdbcSource:
    """Where a table lives. `quote` (the sign around a name) and `literal` (with `{}` for the text of an
    instant) are for databases that Spark's dialects don't fit; without them the dialect of the address holds."""

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    ts_col: str = DEFAULT_TIME_COLUMN
    fetch_size: int = DEFAULT_BATCH_SIZE
    custom_schema: str | None = None
    quote: str | None = None
    literal: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # Names go into SQL text, so they are restricted and not merely quoted.
        if not _TABLE.fullmatch(self.table):
            raise ValueError(f"not a table name: {self.table!r}")
        if self.quote and self.quote in self.ts_col:
            raise ValueError(f"not a column name: {self.ts_col!r}")

    def properties(self) -> dict[str, str]:
        known = {
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            "customSchema": self.custom_schema,
        }
        return {**{k: v for k, v in known.items() if v is not None}, **self.options}


def range_query(
    spark: SparkSession, source: JdbcSource, start_us: int | None = None, end_us: int | None = None
) -> str:
    """The statement that finds the oldest and newest time between the bounds."""
    name = quoted_name(spark, source, source.ts_col)
    bounds = ((">=", start_us), ("<", end_us))
    tests = [f"{name} {op} {instant_literal(spark, source, us)}" for op, us in bounds if us is not None]
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    return f"SELECT MIN({name}) AS oldest, MAX({name}) AS newest FROM {source.table}{where}"


def find_jdbc_range(
    spark: SparkSession,
    source: JdbcSource,
    start: str | None = None,
    end: str | None = None,
    compat: bool = False,
    lenient: bool = False,
) -> TimeRange | None:
    """The range of the table, aggregated by the database; see `operators.ranges` for its meaning."""
    bounds = parse_bounds(spark, start, end, lenient)
    if None not in bounds:
        return TimeRange(*_cut(bounds, compat))
    found = _load(spark, source, range_query(spark, source, *bounds))
    # Some databases return unquoted names in upper case, so the two columns are taken by place.
    oldest, newest = (epoch_us(F.col(c)) for c in found.columns)
    row = found.select(oldest.alias("lo_us"), newest.alias("last_us")).first()
    if row is None or row["lo_us"] is None or row["last_us"] is None:
        return None
    hi_us = row["last_us"] if compat else row["last_us"] + 1
    return TimeRange(*_cut((row["lo_us"], hi_us), compat))


def slice_conditions(spark: SparkSession, source: JdbcSource, slices: list[TimeRange]) -> list[str]:
    """One half-open condition per slice, without gap or overlap between neighbours."""
    name = quoted_name(spark, source, source.ts_col)

    def edge(us: int) -> str:
        return instant_literal(spark, source, us)

    return [f"{name} >= {edge(s.lo_us)} AND {name} < {edge(s.hi_us)}" for s in slices]


def count_query(source: JdbcSource, conditions: list[str], first: int = 0) -> str:
    """The statement that counts the rows under each condition, one row per condition, numbered from `first` on."""
    return " UNION ALL ".join(
        f"SELECT {first + place} AS place, COUNT(*) AS held FROM {source.table} WHERE {condition}"
        for place, condition in enumerate(conditions)
    )


def slice_rows(spark: SparkSession, source: JdbcSource, slices: list[TimeRange]) -> list[int]:
    """The rows of each slice, counted by the database: one Spark job, whose tasks send a statement each."""
    conditions = slice_conditions(spark, source, slices)
    counts = [
        _load(spark, source, count_query(source, conditions[first : first + COUNTS_PER_STATEMENT], first))
        for first in range(0, len(conditions), COUNTS_PER_STATEMENT)
    ]
    held: dict[int, int] = {}
    if counts:  # two numbers per slice
        held = {int(place): int(rows) for place, rows in reduce(DataFrame.unionAll, counts).collect()}
    return [held.get(place, 0) for place in range(len(slices))]


def even_jdbc_slices(
    spark: SparkSession, source: JdbcSource, rng: TimeRange, num_slices: int = DEFAULT_SLICES
) -> list[TimeRange]:
    """About `num_slices` slices with similar row counts.

    The database counts the rows of `FINER` times as many slices of equal width. Those with more than a slice's
    share are cut as fine again and counted, and neighbours are joined: a dense stretch fills many slices.
    """
    fine = slice_ranges(rng, num_slices * FINER)
    rows = slice_rows(spark, source, fine)
    share = -(-sum(rows) // num_slices)
    dense = [k for k, held in enumerate(rows) if held > share and fine[k].hi_us - fine[k].lo_us > FINER * 1000]
    if dense:
        finer = {k: slice_ranges(fine[k], FINER) for k in dense}
        counted = iter(slice_rows(spark, source, [s for k in dense for s in finer[k]]))
        cut = {k: [(s, next(counted)) for s in finer[k]] for k in dense}
        pairs = [pair for k, s in enumerate(fine) for pair in cut.get(k, [(s, rows[k])])]
    else:
        pairs = list(zip(fine, rows))
    return even_slices([(s.lo_us, s.hi_us, held) for s, held in pairs], num_slices)


def read_jdbc(spark: SparkSession, source: JdbcSource, slices: list[TimeRange]) -> DataFrame:
    """The rows of the slices, one Spark partition per slice."""
    return _table(spark, source, slice_conditions(spark, source, slices))


def read_untimed(spark: SparkSession, source: JdbcSource) -> DataFrame:
    """The rows whose time is NULL, which no slice has."""
    return _table(spark, source, [f"{quoted_name(spark, source, source.ts_col)} IS NULL"])


def count_untimed(spark: SparkSession, source: JdbcSource) -> int:
    """How many rows have no time, counted by the database."""
    condition = f"{quoted_name(spark, source, source.ts_col)} IS NULL"
    return int(_load(spark, source, count_query(source, [condition])).first()[1])


def quoted_name(spark: SparkSession, source: JdbcSource, name: str) -> str:
    """A column's name as the database wants it."""
    if source.quote is not None:
        return f"{source.quote}{name}{source.quote}"
    return _dialect(spark, source).quoteIdentifier(name)


def instant_literal(spark: SparkSession, source: JdbcSource, us: int) -> str:
    """An instant as the database wants it, as wall clock in the session zone."""
    java = spark._jvm.java
    moment = java.time.Instant.ofEpochSecond(us // 1_000_000, us % 1_000_000 * 1000)
    zone = java.time.ZoneId.of(spark.conf.get("spark.sql.session.timeZone"))
    clock = java.time.LocalDateTime.ofInstant(moment, zone)
    if source.literal is not None:
        return source.literal.format(_registry(spark).get("jdbc:").compileValue(clock).strip("'"))
    text = _dialect(spark, source).compileValue(clock)
    # A dialect with a form of its own has it for the older class only and leaves this one as it is.
    return text if isinstance(text, str) else _dialect(spark, source).compileValue(java.sql.Timestamp.valueOf(clock))


def _registry(spark: SparkSession):
    return getattr(getattr(spark._jvm.org.apache.spark.sql.jdbc, "JdbcDialects$"), "MODULE$")


def _dialect(spark: SparkSession, source: JdbcSource):
    return _registry(spark).get(native_url(source.url))


def _table(spark: SparkSession, source: JdbcSource, predicates: list[str]) -> DataFrame:
    table = spark.read.jdbc(
        native_url(source.url), source.table, predicates=predicates, properties=source.properties()
    )
    if source.ts_col not in table.columns:
        raise ValueError(f"no time column named exactly {source.ts_col!r} in {table.columns}")
    return table


def _load(spark: SparkSession, source: JdbcSource, statement: str) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", native_url(source.url)).options(**source.properties())
    return reader.option("query", statement).load()


def _cut(bounds: tuple[int, int], compat: bool) -> tuple[int, int]:
    return tuple(us // 1000 * 1000 for us in bounds) if compat else bounds
