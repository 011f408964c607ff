"""The whole job: range, scan, points, optional merge, write, report.

Without a merge this is one stage without a shuffle: every task reads its split,
builds lines in generated code and writes them. What was read, written and lost is observed
in the last stage, which Spark counts once for each task however often it runs; the rows of each
slice are a query over the time column alone.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronoferry.config import MoveOptions
from chronoferry.functions.columns import project
from chronoferry.functions.line import is_writable, line_of
from chronoferry.operators.merge import Packing, merge_points
from chronoferry.operators.points import lost_values, rejected_rows, to_points
from chronoferry.operators.progress import slice_sizes
from chronoferry.operators.ranges import TimeRange, find_range
from chronoferry.operators.slices import slice_ranges
from chronoferry.sinks import Sink
from chronoferry.sources import jdbc
from chronoferry.sources.files import scan
from chronoferry.sources.jdbc import JdbcSource

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MoveReport:
    """What a migration did. `slices` has the rows of each slice, empty ones included."""

    range: TimeRange | None
    read: int = 0
    written: int = 0
    merged: int = 0
    without_fields: int = 0
    lost_values: int = 0
    rejected: int | None = None
    slices: dict[int, int] = field(default_factory=dict)


def migrate(df: DataFrame, sink: Sink, options: MoveOptions, rejects: Sink | None = None) -> MoveReport:
    """Copy a table to a sink.

    Rows without a usable time are counted, and handed to `rejects` if given, in a second scan that
    reads only row groups that have them (on a typed time column).
    """
    rng = find_range(df, options.ts_col, options.start, options.end, options.compat, options.lenient)
    rejected = reject(rejected_rows(df, options.ts_col), rejects)
    if rng is None:
        return MoveReport(None, rejected=rejected)
    sizes = slice_sizes(df, rng, options.ts_col, options.num_slices)
    return _copy(scan(df, rng, options.ts_col, needed_columns(options)), rng, sink, options, rejected, sizes)


def migrate_jdbc(
    spark: SparkSession, source: JdbcSource, sink: Sink, options: MoveOptions, rejects: Sink | None = None
) -> MoveReport:
    """Copy a JDBC table: the database finds the range and counts the slices, each of which is one task.

    Rows without a time are counted by the database, and read only if there is a place for them.
    """
    rng = jdbc.find_jdbc_range(spark, source, options.start, options.end, options.compat, options.lenient)
    if rejects is None:
        rejected = _warned(jdbc.count_untimed(spark, source))
    else:
        rejected = reject(rejected_rows(jdbc.read_untimed(spark, source), options.ts_col), rejects)
    if rng is None:
        return MoveReport(None, rejected=rejected)
    if options.even_slices:
        slices = jdbc.even_jdbc_slices(spark, source, rng, options.num_slices)
    else:
        slices = slice_ranges(rng, options.num_slices)
    sizes = dict(enumerate(jdbc.slice_rows(spark, source, slices)))
    rows = project(jdbc.read_jdbc(spark, source, slices), needed_columns(options))
    return _copy(rows, rng, sink, options, rejected, sizes)


def observed_lines(rows: DataFrame, options: MoveOptions, packing: Packing | None = None) -> tuple[DataFrame, Observation]:
    """The lines of the rows, merged if asked, and what will be seen of them: `read, points, lines, lost`.

    Nothing travels with the rows under a name that a column of the table could have.
    """
    seen = Observation()
    points = to_points(
        rows,
        options.measurement,
        options.ts_col,
        options.decimal,
        options.nested,
        carry=options.merge_by,
        # What the rows are ordered by is no part of the points unless it is asked for.
        ignore=_order_only(options),
        beside={"lost": lost_values(rows, options.decimal, _order_only(options))},
    )
    read = F.count(F.lit(1))
    if options.merge_by:
        points = merge_points(points, packing)
        read = F.sum("merged_rows")
    line = F.when(is_writable(points), line_of(points)).alias("line")
    # Counting once, beside the finished line, leaves the whole conversion in one piece of code.
    carried = ["beside.lost", *(["merged_rows"] if options.merge_by else [])]
    lines = points.select(line, *carried).observe(
        seen,
        F.coalesce(read, F.lit(0)).alias("read"),
        F.count(F.lit(1)).alias("points"),
        F.count("line").alias("lines"),
        F.coalesce(F.sum("lost"), F.lit(0)).alias("lost"),
    )
    return lines.where(F.col("line").isNotNull()).select("line"), seen


def reject(rows: DataFrame, sink: Sink | None) -> int:
    """Hand rejected rows to a sink, or only count them; their number, with a warning."""
    if sink is None:
        return _warned(rows.count())
    counted = Observation()
    sink(rows.observe(counted, F.count(F.lit(1)).alias("rows")))
    return _warned(counted.get["rows"])


def report_of(
    seen: dict, rng: TimeRange, rejected: int | None = None, sizes: dict[int, int] | None = None
) -> MoveReport:
    return MoveReport(
        range=rng,
        read=seen["read"],
        written=seen["lines"],
        merged=seen["read"] - seen["points"],
        without_fields=seen["points"] - seen["lines"],
        lost_values=seen["lost"],
        rejected=rejected,
        slices=sizes or {},
    )


def _copy(
    rows: DataFrame,
    rng: TimeRange,
    sink: Sink,
    options: MoveOptions,
    rejected: int | None,
    sizes: dict[int, int],
) -> MoveReport:
    lines, seen = observed_lines(rows, options)
    sink(lines)
    report = report_of(seen.get, rng, rejected, sizes)
    if report.read != sum(sizes.values()):
        log.warning("the table changed during the copy: %d rows counted, %d read", sum(sizes.values()), report.read)
    return report


def needed_columns(options: MoveOptions) -> tuple[str, ...] | None:
    """Columns to read; None for all."""
    if options.columns is None:
        return None
    return (*options.columns, *_order_only(options))


def _order_only(options: MoveOptions) -> tuple[str, ...]:
    """Columns that are read for the order of a merge only."""
    if options.columns is None:
        return ()
    return tuple(c for c in options.merge_by if c not in options.columns)


def _warned(rejected: int) -> int:
    if rejected:
        log.warning("%d rows have no usable time and are not copied", rejected)
    return rejected
