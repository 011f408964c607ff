"""Streams to two places, merging streams, and what they say of their progress."""

import os
import time

import pytest
from pyspark.sql import functions as F

from chronoferry.config import MoveOptions
from chronoferry.functions.line import to_lines
from chronoferry.operators import logs
from chronoferry.operators.merge import merge_points
from chronoferry.operators.points import to_points
from chronoferry.streaming import (
    ProgressLines,
    copy_merged,
    copy_to_files,
    copy_with_rejects,
    merge_stream,
    merged_points,
    stream_files,
    with_progress,
)


def forget_last_batch(checkpoint):
    """As if the run had died after the outputs of its last batch and before saying so."""
    commits = sorted((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


@pytest.fixture()
def gaps(events, tmp_path):
    """Typed times, some of which are missing, in five files."""
    rows = events.withColumn("ts", F.when(F.col("event_id") % 10 != 3, F.col("ts")))
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    return rows


def test_rejects_of_a_stream_and_a_batch_that_runs_again(spark, gaps, tmp_path):
    options = MoveOptions("e", columns=("ts", "value"), start="2024-01-03", end="2024-01-20")

    def run():
        stream = stream_files(spark, str(tmp_path / "in"), gaps.schema, files_per_batch=2)
        copy_with_rejects(stream, f"{tmp_path}/out", f"{tmp_path}/no", f"{tmp_path}/cp", options).awaitTermination()
        return spark.read.text(f"{tmp_path}/out").select("value"), spark.read.json(f"{tmp_path}/no")

    inside = gaps.where("ts >= '2024-01-03' AND ts < '2024-01-20'").select("ts", "value")
    want = to_lines(to_points(inside, "e"))
    for again in (False, True):
        if again:
            forget_last_batch(f"{tmp_path}/cp")
        lines, refused = run()
        assert lines.exceptAll(want).count() == 0 and lines.count() == want.count()
        assert refused.count() == gaps.where("ts IS NULL").count()
        assert {r.reason for r in refused.select("reason").distinct().collect()} == {"time is null"}
    assert len([n for n in os.listdir(f"{tmp_path}/out") if n.startswith("batch_id=")]) == 3


def points_of(frame, *order):
    return to_points(frame, "l", "l_shipdate", carry=order)


@pytest.mark.parametrize("order", [("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
def test_merging_stream_equals_the_batch(spark, lineitem, tmp_path, order):
    month = F.month("l_shipdate") + 12 * F.year("l_shipdate")
    arrival = F.floor(month / 12) + F.col("l_orderkey") % 2
    for (k,) in sorted(lineitem.select(arrival.cast("int").alias("k")).distinct().collect()):
        lineitem.where(arrival == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.01)
    stream = points_of(stream_files(spark, str(tmp_path / "in"), lineitem.schema, files_per_batch=1), *order)
    want = merge_points(points_of(lineitem, *order))
    for again in (False, True):
        if again:
            forget_last_batch(f"{tmp_path}/cp")
        query = copy_merged(stream, f"{tmp_path}/out", f"{tmp_path}/cp", "800 days")
        query.awaitTermination()
        got = merged_points(spark, f"{tmp_path}/out").select(*want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
        if not again:
            states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
            assert states[-1]["numRowsTotal"] < want.count()  # old identities have left
            assert sum(s["numRowsDroppedByWatermark"] for s in states) == 0


def test_append_mode_gives_past_points_once(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "a", 1, 1.0, None), ("2024-01-01 00:00:00", "a", 2, None, 5), ("2024-01-01 00:00:00", "", 3, 3.0, 1),
            ("2024-03-01 00:00:00", "a", 4, 4.0, 1), ("2024-01-01 00:00:00", "a", 9, 9.0, 9), ("2024-06-01 00:00:00", "a", 5, 5.0, 1)]
    frame = spark.createDataFrame(rows, "ts string, tag string, seq int, v double, n int").withColumn("ts", F.col("ts").cast("timestamp"))
    for part in ("seq IN (1, 2, 3)", "seq = 4", "seq = 5", "seq = 9"):
        frame.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.01)
    stream = stream_files(spark, str(tmp_path / "in"), frame.schema, files_per_batch=1)
    merged = merge_stream(to_points(stream, "m", carry=("seq",), ignore=("seq",)), "10 days")
    copy_to_files(to_lines(merged), f"{tmp_path}/out", f"{tmp_path}/cp", "text").awaitTermination()
    # The row of number 9 comes when its time has been past for two batches.
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect()) == [
        "m n=1i,v=3.0 1704067200000",
        "m,tag=a n=1i,v=4.0 1709251200000",
        "m,tag=a n=5i,v=1.0 1704067200000",
    ]


def test_a_stream_needs_an_order_too(spark, events, tmp_path):
    events.write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="order"):
        merge_stream(to_points(stream_files(spark, str(tmp_path / "in"), events.schema), "e"), "1 day")


def test_progress_lines_of_a_stream(spark, events, tmp_path):
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    listener = ProgressLines(spark, str(tmp_path / "logs"))
    spark.streams.addListener(listener)
    try:
        stream = with_progress(stream_files(spark, str(tmp_path / "in"), events.schema, files_per_batch=1))
        lines = to_lines(to_points(stream, "e"))
        copy_to_files(lines, f"{tmp_path}/out", f"{tmp_path}/cp", "text").awaitTermination()
        broken = with_progress(stream_files(spark, str(tmp_path / "in"), events.schema))
        broken = broken.withColumn("value", F.raise_error(F.lit("no more")).cast("double"))
        with pytest.raises(Exception, match="no more"):
            copy_to_files(to_lines(to_points(broken, "e")), f"{tmp_path}/out2", f"{tmp_path}/cp2", "text").awaitTermination()
        until = time.time() + 20
        while time.time() < until and sum(n.endswith(".log") for n in os.listdir(tmp_path / "logs")) < 4:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    read = logs.read_logs(spark, str(tmp_path / "logs"))
    progress = logs.parse_progress(read).collect()
    assert len(progress) == 3 and sum(r.records for r in progress) == events.count()
    first = events.agg(F.min("ts").cast("string")).first()[0]
    assert min(r.slice_start for r in progress) == first
    assert [r.value.split(":")[0] for r in logs.last_problem_lines(read).collect()] == ["ERROR the stream ended"]


def test_merging_within_a_batch_by_columns_that_are_not_copied(spark, events, tmp_path):
    doubled = events.select("ts", F.col("value").alias("a.b"), F.col("event_id").alias("order")).union(
        events.select("ts", F.lit(-1.0), F.lit(-1)))
    doubled.coalesce(1).write.parquet(str(tmp_path / "in"))
    options = MoveOptions("e", columns=("ts", "a.b"), merge_by=("order",))
    stream = stream_files(spark, str(tmp_path / "in"), doubled.schema)
    copy_with_rejects(stream, f"{tmp_path}/out", f"{tmp_path}/no", f"{tmp_path}/cp", options).awaitTermination()
    got = spark.read.text(f"{tmp_path}/out").select("value")
    want = to_lines(to_points(events.select("ts", F.col("value").alias("a.b")), "e"))
    assert got.count() == events.count() and got.exceptAll(want).count() == 0
