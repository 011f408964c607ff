"""A stream to two places: lines of the points, and the rows that can't be points.

Each micro-batch writes a folder of its number below either place and replaces what an earlier attempt
at that number left there, so a batch that runs again adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chronoferry.config import MoveOptions
from chronoferry.functions.columns import project
from chronoferry.operators.points import rejected_rows
from chronoferry.operators.ranges import between, parse_bounds
from chronoferry.plans.migrate import needed_columns, observed_lines, reject
from chronoferry.streaming.copy import start_stream

BATCH = "batch_id"


def copy_with_rejects(
    stream: DataFrame,
    target: str,
    rejects: str,
    checkpoint: str,
    options: MoveOptions,
    interval: str | None = None,
    compression: str = "none",
) -> StreamingQuery:
    """Write lines as text below `target`, and rows without a usable time as JSON (`reason, row_json`) below `rejects`.

    Bounds and columns are those of the options; points of equal identity are merged within a batch if asked.
    A batch is read once for each place; on a typed time column the second reading skips row groups without NULLs.
    """
    start_us, end_us = parse_bounds(stream.sparkSession, options.start, options.end, options.lenient)

    def both(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(between(batch, options.ts_col, start_us, end_us))
        lines, _ = observed_lines(project(rows, needed_columns(options)), options)
        lines.write.mode("overwrite").option("compression", compression).text(f"{target}/{BATCH}={batch_id}")
        refused = f"{rejects}/{BATCH}={batch_id}"
        reject(rejected_rows(batch, options.ts_col), lambda r: r.write.mode("overwrite").json(refused))

    return each_batch(stream, both, checkpoint, interval)


def each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to a function that may be called again with the same batch."""
    return start_stream(stream.writeStream.foreachBatch(write), checkpoint, interval, mode)
