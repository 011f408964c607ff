"""A stopped copy goes on; nothing is copied twice or left out."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from chronoferry.config import MoveOptions
from chronoferry.functions.line import to_lines
from chronoferry.operators import logs
from chronoferry.operators.points import to_points
from chronoferry.operators.ranges import find_range
from chronoferry.operators.slices import slice_ranges
from chronoferry.plans.resume import copied_lines, migrate_jdbc_resumable, migrate_resumable
from chronoferry.restart import restarted
from chronoferry.sources import jdbc
from chronoferry.sources.jdbc import JdbcSource

OPTIONS = MoveOptions("e", num_slices=6, batch_size=2)


def failing(events, k, slices=6):
    """The table with a source that is lost from slice k on."""
    edge = slice_ranges(find_range(events), slices)[k].lo_us
    lost = F.when(F.unix_micros(F.col("ts").cast("timestamp")) >= edge, F.raise_error(F.lit("lost")))
    return events.withColumn("value", lost.otherwise(F.col("value")))


def same(spark, target, events):
    want = to_lines(to_points(events, "e"))
    got = copied_lines(spark, target)
    return got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("at_once", [1, 3])
def test_a_stopped_copy_goes_on(spark, events, tmp_path, at_once):
    target, notes = str(tmp_path / "out"), str(tmp_path / "logs")
    with pytest.raises(Exception, match="lost"):
        migrate_resumable(failing(events, 3), target, OPTIONS, at_once=at_once, log_folder=notes)
    assert not same(spark, target, events)
    problems = logs.last_problem_lines(logs.read_logs(spark, notes)).collect()
    assert 1 <= len(problems) <= at_once and problems[0].value.startswith("ERROR Error in time partition 2024-")
    # A folder whose job ended before it was written down, and what a job left half done.
    os.makedirs(f"{target}/part_id=5", exist_ok=True)
    with open(f"{target}/part_id=5/part-0.txt", "w") as file:
        file.write("stray 1\n")
    report = migrate_resumable(events, target, OPTIONS, at_once=at_once, log_folder=notes)
    assert report.copied == (3, 4, 5) and same(spark, target, events)
    assert report.read == sum(report.slices[k].read for k in (3, 4, 5)) < report.written == events.count()
    again = migrate_resumable(events, target, OPTIONS)
    assert again.copied == () and again.read == 0 and again.written == events.count()
    progress = logs.latest_progress(logs.read_logs(spark, notes)).collect()
    assert sorted(r.records for r in progress) == sorted(s.read for s in report.slices.values())
    assert all(r.done for r in progress)


def test_restarts_until_it_is_done(spark, events, tmp_path):
    tables = [failing(events, 2), failing(events, 4), events]
    report = restarted(lambda: migrate_resumable(tables.pop(0), str(tmp_path), OPTIONS), attempts=3, delay_s=0)
    assert report.copied == (4, 5) and same(spark, str(tmp_path), events)


def test_the_first_plan_holds(spark, events, tmp_path):
    target = str(tmp_path / "out")
    early = events.where("event_id < 500")
    with pytest.raises(Exception, match="lost"):
        migrate_resumable(failing(early, 3), target, OPTIONS)
    last = find_range(early).hi_us
    report = migrate_resumable(events, target, OPTIONS)
    assert report.range.hi_us == last
    assert same(spark, target, events.where(F.unix_micros(F.col("ts").cast("timestamp")) < last))
    for other in (MoveOptions("f", num_slices=6), MoveOptions("e", num_slices=7), MoveOptions("e", num_slices=6, decimal="double")):
        with pytest.raises(ValueError, match="other options"):
            migrate_resumable(events, target, other)
    migrate_resumable(events, target, MoveOptions("e", num_slices=6, batch_size=9))


def test_a_slice_whose_entry_is_missing_is_done_anew(spark, events, tmp_path):
    target = str(tmp_path / "out")
    migrate_resumable(events, target, OPTIONS, compression="gzip")
    os.remove(f"{target}/_manifest/slice-00002")
    shutil.rmtree(f"{target}/part_id=2")
    assert migrate_resumable(events, target, OPTIONS).copied == (2,) and same(spark, target, events)


def test_nothing_to_copy(spark, events, tmp_path):
    target = str(tmp_path / "out")
    options = MoveOptions("e", start="2031-01-01 00:00:00")
    for _ in range(2):
        report = migrate_resumable(events, target, options)
        assert (report.range, report.slices, report.copied, report.rejected) == (None, {}, (), 0)
    assert copied_lines(spark, target).count() == 0


@pytest.mark.parametrize("even", [False, True])
def test_jdbc_slices(spark, events, tmp_path, monkeypatch, even):
    events.createOrReplaceTempView("resumed_events")
    source = JdbcSource("jdbc:x://h/d", "resumed_events", quote="`", literal="TIMESTAMP_NTZ'{}'")
    read = []

    def table(spark, source, predicates):
        read.append(len(predicates))
        return spark.table(source.table).where(" OR ".join(f"({p})" for p in predicates))

    monkeypatch.setattr(jdbc, "_table", table)
    monkeypatch.setattr(jdbc, "_load", lambda spark, source, statement: spark.sql(statement))
    options = MoveOptions("e", num_slices=4, even_slices=even)
    report = migrate_jdbc_resumable(spark, source, str(tmp_path), options, tasks_per_slice=3)
    assert report.written == events.count() and read == [3] * len(report.slices) and same(spark, str(tmp_path), events)
    assert report.rejected == 0


def test_rejects_are_written_once(spark, events, tmp_path):
    target, refused = str(tmp_path / "out"), str(tmp_path / "no")
    rows = events.withColumn("ts", F.when(F.col("event_id") % 10 != 3, F.col("ts")))
    without = rows.where("ts IS NULL").count()
    with pytest.raises(Exception, match="lost"):
        migrate_resumable(failing(rows, 2), target, OPTIONS, rejects=refused)
    report = migrate_resumable(rows, target, OPTIONS, rejects=str(tmp_path / "not used any more"))
    assert report.rejected == without == spark.read.json(refused).count() and report.written == events.count() - without
    assert not os.path.exists(tmp_path / "not used any more")
