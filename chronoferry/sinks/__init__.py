"""Where lines go. A sink is a function that takes the frame of lines and writes it."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoferry.config import DEFAULT_BATCH_SIZE, fresh_folder, remove_folder, ship_package
from chronoferry.sinks.endpoint import FORMAT, LineEndpoint

Sink = Callable[[DataFrame], None]

# Bytes of lines that a writer gets in one task.
TASK_BYTES = 256 << 20


def line_files(path: str, compression: str = "none", mode: str = "errorifexists") -> Sink:
    """Text files below `path`, committed as a whole when every task has succeeded."""
    return lambda lines: lines.write.mode(mode).option("compression", compression).text(path)


def line_endpoint(
    url: str,
    token: str,
    org: str,
    bucket: str,
    batch_size: int = DEFAULT_BATCH_SIZE,
    writers: int | None = None,
    **options: object,
) -> Sink:
    """A line-protocol endpoint; `writers` bounds how many tasks send at the same time.

    With a bound the lines are made by as many tasks as ever and stored, and then sent in rounds of so many tasks, each
    of which gets about TASK_BYTES of them at most. Its bodies are full; the last of all may be shorter.
    """

    def write(lines: DataFrame) -> None:
        ship_package(lines.sparkSession)
        lines.sparkSession.dataSource.register(LineEndpoint)
        settings = {"url": url, "token": token, "org": org, "bucket": bucket, "batch_size": batch_size, **options}
        for frame in [lines] if writers is None else dealt(lines, writers, batch_size):
            frame.write.format(FORMAT).mode("append").options(**settings).save()

    return write


def dealt(lines: DataFrame, writers: int, batch_size: int) -> Iterator[DataFrame]:
    """The lines as frames of `writers` tasks: every task has whole bodies, but for the last one of all.

    Lines are stored once, numbered within the task that made them. The numbers of a frame are a range, by which
    it reads its files alone.
    """
    spark = lines.sparkSession
    stored = fresh_folder(spark, "dealt")
    # The number of the task, and that of the line in it in the lower 33 bits.
    lines.select(F.col(lines.columns[0]).alias("line"), F.monotonically_increasing_id().alias("at")).write.parquet(stored)
    rows = spark.read.schema("line string, at long").parquet(stored)
    part = F.shiftright("at", 33)
    sizes = F.count("*").alias("n"), F.sum(F.octet_length("line") + 1).alias("bytes")
    parts = rows.groupBy(part.alias("part")).agg(*sizes).orderBy("part").collect()
    total = sum(p.n for p in parts)
    if not total:
        yield rows.select("line").coalesce(1)
        return
    fronts = [0, *accumulate(p.n for p in parts)]
    wanted = TASK_BYTES * total // max(sum(p.bytes or 0 for p in parts), 1)
    share = max(1, min(wanted // batch_size, -(-total // (batch_size * writers)))) * batch_size

    def place(number: int) -> int:
        k = bisect_right(fronts, number) - 1
        return (parts[k].part << 33) + number - fronts[k] if k < len(parts) else 1 << 62

    for first in range(0, total, share * writers):
        edges = [place(min(number, total)) for number in range(first, first + share * writers + 1, share)]
        sent = rows.where((F.col("at") >= edges[0]) & (F.col("at") < edges[-1]))
        if writers > 1:
            passed = sum(((F.col("at") >= edge).cast("int") for edge in edges[1:-1]), F.lit(0))
            yield sent.repartitionById(writers, passed).select("line")
        else:
            yield sent.select("line").coalesce(1)
    remove_folder(spark, stored)


__all__ = ["LineEndpoint", "Sink", "line_endpoint", "line_files"]
