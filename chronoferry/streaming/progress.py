"""Progress lines of a running stream, in the words that the log reports look for."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from chronoferry.functions.columns import time_value
from chronoferry.functions.timestamps import epoch_us, instant_text
from chronoferry.operators.logs import PROGRESS_FORMAT
from chronoferry.sinks.folder import SharedFolder

log = logging.getLogger(__name__)

METRICS = "chronoferry_progress"


def with_progress(stream: DataFrame, ts_col: str = "ts") -> DataFrame:
    """The same stream, counted while it passes: rows, first and last time of every batch."""
    us = epoch_us(time_value(stream, ts_col))
    return stream.observe(METRICS, F.count(us).alias("rows"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))


class ProgressLines(StreamingQueryListener):
    """Writes a line for every batch of a stream `with_progress`, into a file per batch, and one if the stream fails.

        spark.streams.addListener(ProgressLines(spark, "hdfs:///logs/copy"))

    A batch that is run again writes its file again.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._folder = SharedFolder(spark, folder)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRICS)
        if seen is None or not seen["rows"]:
            return
        times = instant_text(seen["first_us"]), instant_text(seen["last_us"])
        line = "INFO " + PROGRESS_FORMAT.format(seen["rows"], *times)
        log.info("%s", line)
        self._folder.write(f"stream-{progress.id}-{progress.batchId:09d}.log", [line])

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            cause = event.exception.strip().splitlines()[0]
            self._folder.write(f"stream-{event.id}-failed-{event.runId}.log", [f"ERROR the stream ended: {cause}"])
