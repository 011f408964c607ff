import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from support import instants, plan_of

from chronoferry.config import MoveOptions
from chronoferry.operators import logs
from chronoferry.operators.progress import milestones, slice_sizes, slice_totals
from chronoferry.operators.ranges import find_range
from chronoferry.operators.slices import slice_ranges
from chronoferry.plans.migrate import migrate
from chronoferry.sinks import line_files

LINES = [
    "INFO Processed 20000 records from time partition 2024-01-01 00:00:00.0 to 2024-01-02 00:00:00.0",
    "something else",
    "INFO Processed 20000 records from time partition 2024-01-02 00:00:00.0 to 2024-01-03 00:00:00.0",
    "WARN slow",
    "INFO Processed 40000 records from time partition 2024-01-01 00:00:00.0 to 2024-01-02 00:00:00.0",
    "INFO Completed processing time partition 2024-01-02 00:00:00.0 to 2024-01-03 00:00:00.0, total records: 20417",
    "java.lang.IllegalStateException: no",
    "Error fetching data",
    "processed in lower case",
    "Processed nothing in particular",
]


def lines(spark):
    return spark.createDataFrame(list(enumerate(LINES)), "pos bigint, value string")


def test_totals_show_empty_slices(spark):
    df = instants(spark, ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-05 00:00:00"])
    rows = slice_totals(df, find_range(df), "ts", 4).orderBy("part_id").collect()
    assert [r.total for r in rows] == [2, 0, 0, 1]


def test_milestones_by_hand(spark):
    totals = {0: 0, 1: 19, 2: 20, 3: 45, 4: 50_003}
    df = spark.createDataFrame(list(totals.items()), "part_id bigint, total bigint")
    got = sorted((r.part_id, r.processed) for r in milestones(df, 2).collect())
    assert got == [(k, n) for k, t in totals.items() for n in range(20, t + 1, 20)]


@pytest.mark.parametrize("num_slices", [8, 64, 300, 2_000])
def test_slices_of_many_tasks_are_counted_exactly(spark, lineitem, tmp_path, num_slices):
    """Sixteen files, each with rows of all slices."""
    lineitem.repartition(16).write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    rng = find_range(rows, "l_shipdate")
    edges = slice_ranges(rng, num_slices)
    want = dict.fromkeys(range(num_slices), 0)
    for row in rows.groupBy("l_shipdate").count().collect():
        us = int(row.l_shipdate.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000 + row.l_shipdate.microsecond
        want[next(k for k, e in enumerate(edges) if e.lo_us <= us < e.hi_us)] += row["count"]
    assert slice_sizes(rows, rng, "l_shipdate", num_slices) == want
    for merge_by in ((), ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")):
        options = MoveOptions("l", ts_col="l_shipdate", num_slices=num_slices, merge_by=merge_by)
        report = migrate(rows, line_files(str(tmp_path / f"out{len(merge_by)}")), options)
        assert report.slices == want and report.read == rows.count()


def test_last_lines(spark):
    got = logs.last_progress_lines(lines(spark), 2).orderBy("pos").collect()
    assert [r.pos for r in got] == [4, 9]
    got = logs.last_problem_lines(lines(spark)).orderBy("pos").collect()
    assert [r.pos for r in got] == [3, 6, 7]
    assert "TakeOrderedAndProject" in plan_of(logs.last_problem_lines(lines(spark)))


def test_latest_report_of_each_slice(spark):
    got = {r.slice_start[8:10]: (r.records, r.done, r.pos) for r in logs.latest_progress(lines(spark)).collect()}
    assert got == {"01": (40_000, False, 4), "02": (20_417, True, 5)}


def test_messages_are_parsed_as_written(spark):
    text = [F.lit("2024-01-01 00:00:00.0"), F.lit("2024-01-02 00:00:00.0")]
    df = spark.range(1).select(
        F.explode(F.array(logs.progress_line(F.lit(7), *text), logs.completed_line(F.lit(9), *text))).alias("value"),
        F.lit(0).alias("pos"),
    )
    got = sorted((r.records, r.done, r.slice_start, r.slice_end) for r in logs.parse_progress(df).collect())
    times = ("2024-01-01 00:00:00.0", "2024-01-02 00:00:00.0")
    assert got == [(7, False, *times), (9, True, *times)]


def test_lines_of_files_are_ordered_by_age_and_place(spark, tmp_path):
    for age, (name, content) in enumerate([("b.log", LINES[:4]), ("a.log", LINES[4:])]):
        path = tmp_path / name
        path.write_text("\n".join(content) + "\n")
        os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))
    read = logs.read_logs(spark, str(tmp_path))
    assert [r.value for r in read.orderBy("pos").collect()] == LINES
    assert [r.value for r in logs.last_problem_lines(read, 2).orderBy("pos").collect()] == LINES[6:8]
    assert {r.records for r in logs.latest_progress(read).collect()} == {40_000, 20_417}
