"""Following job logs: every new line that matches is appended once.

`append_matches` takes files that are complete when they appear, as rolled files are, and splits them by
Spark's own reader; `append_growing` takes files that are still being written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronoferry.sources.growing import growing_lines
from chronoferry.streaming.copy import copy_to_files


def follow_logs(spark: SparkSession, path: str, pattern: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines that match a regular expression, of a folder that gets new files, as a stream."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).where(F.col("value").rlike(pattern))


def append_matches(
    spark: SparkSession, path: str, pattern: str, out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append matching lines to text files, polling at an interval or up to the present end."""
    return copy_to_files(follow_logs(spark, path, pattern), out, checkpoint, "text", interval)


def append_growing(
    spark: SparkSession,
    path: str,
    pattern: str,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    names: str = "*",
) -> StreamingQuery:
    """The same for files that grow: whole lines only, each once; `names` says which files are meant."""
    matches = growing_lines(spark, path, names).where(F.col("value").rlike(pattern)).select("value")
    return copy_to_files(matches, out, checkpoint, "text", interval)
