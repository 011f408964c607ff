"""Progress and problems out of job logs, read as a table of lines."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two progress messages, what the reports look for, and how much they show.
PROGRESS_WORD = "Processed"
PROGRESS_FORMAT = "Processed {} records from time partition {} to {}"
COMPLETED_FORMAT = "Completed processing time partition {} to {}, total records: {}"
PROBLEM_PATTERN = "(?i)error|warn|exception"
PROGRESS_LINES = 100
PROBLEM_LINES = 20


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """`pos, value` of every line below a path. `pos` orders the lines: file age, file, place in the file."""
    return spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("pos"),
        "value",
    )


def progress_line(records: Column, lo_text: Column, hi_text: Column) -> Column:
    """The message a slice logs on its way."""
    return _fill(PROGRESS_FORMAT, records.cast("string"), lo_text, hi_text)


def completed_line(records: Column, lo_text: Column, hi_text: Column) -> Column:
    """The message a slice logs at its end."""
    return _fill(COMPLETED_FORMAT, lo_text, hi_text, records.cast("string"))


def progress_messages(total: int, step: int, lo_text: str, hi_text: str) -> Iterator[str]:
    """What a job writes of a slice with `total` rows: a line every `step` rows, and one at the end."""
    for records in range(step, total + 1, step):
        yield "INFO " + PROGRESS_FORMAT.format(records, lo_text, hi_text)
    yield "INFO " + COMPLETED_FORMAT.format(lo_text, hi_text, total)


def last_progress_lines(lines: DataFrame, count: int = PROGRESS_LINES) -> DataFrame:
    """The newest lines that speak of progress: a top-k, each task keeps `count` lines."""
    return lines.where(F.contains("value", F.lit(PROGRESS_WORD))).orderBy(F.desc("pos")).limit(count)


def last_problem_lines(lines: DataFrame, count: int = PROBLEM_LINES) -> DataFrame:
    """The newest lines that speak of an error, warning or exception."""
    return lines.where(F.col("value").rlike(PROBLEM_PATTERN)).orderBy(F.desc("pos")).limit(count)


def parse_progress(lines: DataFrame) -> DataFrame:
    """`pos, slice_start, slice_end, records, done` of every progress or completion line.

    A line is cut at the fixed texts of the messages; its last three pieces are the
    values. That is one pass over the text instead of a pattern per value.
    """
    on_way, at_end = (F.contains("value", F.lit(_fixed_texts(m)[0])) for m in (PROGRESS_FORMAT, COMPLETED_FORMAT))
    cuts = "|".join(re.escape(text) for m in (PROGRESS_FORMAT, COMPLETED_FORMAT) for text in _fixed_texts(m))
    pieces = lines.where(on_way | at_end).select("pos", at_end.alias("done"), F.split("value", cuts).alias("piece"))

    def piece(on_way: int, at_end: int) -> Column:
        place = F.when(F.col("done"), F.lit(at_end)).otherwise(F.lit(on_way))
        return F.try_element_at("piece", place)

    return pieces.select(
        "pos",
        piece(-2, -3).alias("slice_start"),
        F.rtrim(piece(-1, -2)).alias("slice_end"),
        F.rtrim(piece(-3, -1)).try_cast("bigint").alias("records"),
        "done",
    ).where(F.col("records").isNotNull())


def latest_progress(lines: DataFrame) -> DataFrame:
    """The newest report of every slice; lines of a slice are reduced before the shuffle."""
    return (
        parse_progress(lines)
        .groupBy("slice_start", "slice_end")
        .agg(
            F.max_by("records", "pos").alias("records"),
            F.max_by("done", "pos").alias("done"),
            F.max("pos").alias("pos"),
        )
    )


def _fill(message: str, *values: Column) -> Column:
    texts = [F.lit(text) for text in message.split("{}")]
    return F.concat(texts[0], *(part for pair in zip(values, texts[1:]) for part in pair))


def _fixed_texts(message: str) -> list[str]:
    return [text for text in message.split("{}") if text]
