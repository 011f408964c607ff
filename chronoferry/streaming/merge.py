"""Points of equal identity become one while they arrive.

Spark keeps one row per identity as state: the last present value of each field and its order, and the number
of rows. An identity leaves the state when its time is older than the newest one by more than the delay; rows
that come later than that are dropped, which Spark counts in the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronoferry.functions.columns import field_of
from chronoferry.operators.merge import flat_points, merged_columns, merging
from chronoferry.operators.points import layout_of_points
from chronoferry.streaming.split import BATCH, each_batch


def merge_stream(points: DataFrame, delay: str) -> DataFrame:
    """Merged points of a stream of points with a `seq` struct (see `operators.merge`).

    Write them in update mode to get an identity again whenever it changes, or in append mode to get it once,
    when its time is past; what is not past when the stream ends is not written in append mode.
    """
    if "seq" not in points.columns:
        raise ValueError("merging needs an order: build the points with carry=(columns, ...)")
    layout = layout_of_points(points)
    members = points.schema["seq"].dataType.fieldNames()
    order = field_of("seq", members[0]) if len(members) == 1 else F.col("seq")
    flat, keys = flat_points(points, layout, order)
    timed = flat.withColumn("at", F.timestamp_millis("ts_ms")).drop("ts_ms").withWatermark("at", delay)
    merged = timed.groupBy("at", *keys, "measurement").agg(*merging(points, layout))
    return merged_columns(merged.withColumn("ts_ms", F.unix_millis("at")), points, layout)


def copy_merged(
    points: DataFrame, target: str, checkpoint: str, delay: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the merged points of a stream below `target`: every batch writes those that it changed.

    `merged_points` reads the newest of each; an endpoint would overwrite the older ones by itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    return each_batch(merge_stream(points, delay), write, checkpoint, interval, "update")


def merged_points(spark: SparkSession, target: str) -> DataFrame:
    """The newest state of every identity that `copy_merged` has written: one shuffle, reduced before it."""
    rows = spark.read.parquet(target)
    keys = [c for c in ("measurement", "ts_ms", "tags") if c in rows.columns]
    others = [c for c in rows.columns if c not in (*keys, BATCH)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), BATCH).alias("newest"))
    return newest.select(*keys, "newest.*")
