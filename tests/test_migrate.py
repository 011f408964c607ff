import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import plan_of

from chronoferry.config import MoveOptions, fresh_folder, work_folder
from chronoferry.functions.line import to_lines
from chronoferry.operators.points import to_points
from chronoferry.plans.migrate import MoveReport, migrate, migrate_jdbc
from chronoferry.sinks import line_files
from chronoferry.sources import jdbc
from chronoferry.sources.jdbc import JdbcSource

AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_whole_table(spark, events, tmp_path):
    report = migrate(events, line_files(str(tmp_path / "out")), MoveOptions("events", num_slices=4))
    n = events.count()
    assert (report.read, report.written, report.merged, report.without_fields) == (n, n, 0, 0)
    assert report.rejected == 0 and sum(report.slices.values()) == n and len(report.slices) == 4
    got = spark.read.text(str(tmp_path / "out"))
    expected = to_lines(to_points(events, "events"))
    assert got.exceptAll(expected).count() == 0 and got.count() == n


def test_bounds_and_columns(spark, events, tmp_path):
    options = MoveOptions(
        "e", start="2024-01-08 00:00:00", end="2024-01-15 00:00:00", columns=("ts", "value", "event_type")
    )
    report = migrate(events, line_files(str(tmp_path / "out")), options)
    inside = events.where("ts >= '2024-01-08' AND ts < '2024-01-15'")
    assert report.read == report.written == inside.count()
    assert "user_id" not in spark.read.text(str(tmp_path / "out")).first().value


def test_compat_copies_one_row_less(events, tmp_path):
    report = migrate(events, line_files(str(tmp_path / "out")), MoveOptions("e", compat=True))
    assert report.read == events.count() - 1


def test_merge_rejects_and_lost_values(spark, tmp_path):
    rows = [
        (AT, "a", 1, 1.0, Decimal(1)),
        (AT, "a", 2, None, Decimal(10) ** 30),
        (AT, "b", 3, None, None),
        (None, "c", 4, 1.0, None),
    ]
    df = spark.createDataFrame(rows, "ts timestamp, tag string, seq bigint, v double, big decimal(38,0)")
    rejected = []
    options = MoveOptions("m", merge_by=("seq",))

    def keep(rows):
        rejected.extend(r.row_json for r in rows.collect())

    report = migrate(df, line_files(str(tmp_path / "out")), options, rejects=keep)
    assert (report.read, report.merged, report.written, report.rejected) == (3, 1, 2, 1)
    assert report.lost_values == 1 and report.without_fields == 0
    assert len(rejected) == 1 and '"tag":"c"' in rejected[0]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == [
        "m,tag=a big=1i,seq=2i,v=1.0 1704067200000",
        "m,tag=b seq=3i 1704067200000",
    ]


def test_points_without_fields_are_counted(spark, tmp_path):
    df = spark.createDataFrame([(AT, 1), (AT, None)], "ts timestamp, v int")
    report = migrate(df, line_files(str(tmp_path / "out")), MoveOptions("m"))
    assert (report.read, report.written, report.without_fields) == (2, 1, 1)


def test_nothing_to_move(events):
    def fail(lines):
        raise AssertionError("nothing should be written")

    assert migrate(events, fail, MoveOptions("e", start="2031-01-01 00:00:00")) == MoveReport(None, rejected=0)


@pytest.mark.parametrize("even", [False, True])
def test_jdbc_job_on_a_stubbed_connection(spark, events, tmp_path, monkeypatch, even):
    """Statements and predicates are run by Spark on a view of that name."""
    rows = events.withColumn("ts", F.when(F.col("event_id") % 10 != 3, F.col("ts")))
    rows.createOrReplaceTempView("some_rows")
    source = JdbcSource("jdbc:x://h/d", "some_rows", quote="`", literal="TIMESTAMP_NTZ'{}'")
    asked = []

    def read(spark, source, predicates):
        asked.append(predicates)
        return spark.table(source.table).where(" OR ".join(f"({p})" for p in predicates))

    monkeypatch.setattr(jdbc, "_table", read)
    monkeypatch.setattr(jdbc, "_load", lambda spark, source, statement: spark.sql(statement))
    without = rows.where("ts IS NULL").count()
    kept = []
    for rejects in (None, lambda refused: kept.extend(r.reason for r in refused.collect())):
        options = MoveOptions("e", num_slices=3, even_slices=even)
        report = migrate_jdbc(spark, source, line_files(str(tmp_path / f"out{rejects is None}")), options, rejects)
        assert report.rejected == without and report.written == report.read == events.count() - without
        assert sum(report.slices.values()) == report.read and all(report.slices.values())
    assert kept == ["time is null"] * without
    assert asked[1] == ["`ts` IS NULL"] and len(asked[0]) == len(report.slices)


def test_columns_may_be_called_anything(spark, tmp_path):
    df = spark.createDataFrame([(AT, 1, 7, 2.0)], "ts timestamp, __slice int, lost int, merged_rows double")
    for merge_by in ((), ("lost",), ("lost", "__slice")):
        out = str(tmp_path / f"out{len(merge_by)}")
        migrate(df, line_files(out), MoveOptions("m", merge_by=merge_by))
        assert spark.read.text(out).first().value == "m __slice=1i,lost=7i,merged_rows=2.0 1704067200000"


def test_order_columns_need_not_be_copied(spark, tmp_path):
    df = spark.createDataFrame([(AT, 1, 5, 1.0), (AT, 2, 4, 2.0)], "ts timestamp, a int, b int, v double")
    migrate(df, line_files(str(tmp_path / "out")), MoveOptions("m", columns=("ts", "v"), merge_by=("b", "a")))
    assert spark.read.text(str(tmp_path / "out")).first().value == "m v=1.0 1704067200000"


def test_options_are_checked():
    for wrong in ({"measurement": ""}, {"measurement": "m", "num_slices": 0}, {"measurement": "m", "batch_size": 0}):
        with pytest.raises(ValueError):
            MoveOptions(**wrong)
    assert (MoveOptions("m").num_slices, MoveOptions("m").batch_size) == (8, 2000)


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_rejects_scan_only_row_groups_with_nulls(events):
    from chronoferry.operators.points import rejected_rows

    assert "PushedFilters: [IsNull(ts)]" in plan_of(rejected_rows(events))
    assert rejected_rows(events.withColumn("ts", F.lit(None).cast("timestamp"))).count() == events.count()


def test_measurement_that_hides_its_lines():
    with pytest.raises(ValueError, match="comment"):
        MoveOptions("#cpu")
