"""The resumable form of the copy: files as a stream, progress in a checkpoint.

Each file is read once. The file sink records which files of a micro-batch belong
to it, so a batch that is run again after a loss replaces its own output; a run
that starts from the same checkpoint goes on where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from chronoferry.config import RESTART_ATTEMPTS, RESTART_DELAY_S, pickle_whole, ship_package
from chronoferry.functions.line import to_lines
from chronoferry.restart import restarted
from chronoferry.sinks.endpoint import FORMAT, LineEndpoint


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """Files below a path as a stream; `files_per_batch` is the throttle."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def copy_to_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", interval: str | None = None
) -> StreamingQuery:
    """Append the rows of a stream to files. Without an interval it stops at the end of the input."""
    return start_stream(stream.writeStream.format(fmt).option("path", path), checkpoint, interval)


def copy_to_endpoint(
    points: DataFrame, checkpoint: str, interval: str | None = None, **options: object
) -> StreamingQuery:
    """Send the points of a stream to a line-protocol endpoint, at least once each."""
    ship_package(points.sparkSession)
    pickle_whole("chronoferry.sinks.endpoint", "chronoferry.sinks.transport")
    points.sparkSession.dataSource.register(LineEndpoint)
    return start_stream(to_lines(points).writeStream.format(FORMAT).options(**options), checkpoint, interval)


def run_to_end(
    start: Callable[[], StreamingQuery], attempts: int = RESTART_ATTEMPTS, delay_s: float = RESTART_DELAY_S
) -> None:
    """Run a stopping query to its end, starting it again from its checkpoint up to `attempts` times."""
    restarted(lambda: start().awaitTermination(), attempts, delay_s)


def start_stream(
    writer: DataStreamWriter, checkpoint: str, interval: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Start a query that polls at an interval, or without one stops at the present end of its input."""
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()
