"""The JDBC path up to the connection; no database runs in the tests."""

import pytest
from support import instants

from chronoferry.operators.ranges import TimeRange, find_range
from chronoferry.operators.slices import even_slices, slice_ranges
from chronoferry.sources import jdbc
from chronoferry.sources.endpoint import native_url
from chronoferry.sources.jdbc import JdbcSource, find_jdbc_range, range_query, slice_conditions

SOURCE = JdbcSource("jdbc:x://host/db", "db.sensors", user="u", password="p", fetch_size=500)


@pytest.mark.parametrize(
    "given, native",
    [
        ("jdbc:TAOS-RS://host:6041/db", "jdbc:TAOS://host:6030/db"),
        ("jdbc:TAOS-RS://host:7000/db?a=b", "jdbc:TAOS://host:7000/db?a=b"),
        ("jdbc:TAOS://host:6041/db", "jdbc:TAOS://host:6041/db"),
        ("jdbc:other://host:6041/db", "jdbc:other://host:6041/db"),
    ],
)
def test_addresses(given, native):
    assert native_url(given) == native


def test_unknown_address_is_reported(caplog):
    native_url("jdbc:other://host/db?password=hidden")
    assert "jdbc:other://host/db" in caplog.text and "hidden" not in caplog.text


def test_properties_and_secrets():
    assert SOURCE.properties() == {"user": "u", "password": "p", "fetchsize": "500"}
    assert "'p'" not in repr(SOURCE)


@pytest.mark.parametrize("table", ["a; DROP TABLE b", "a b", "", "a.b.c.d", "a--", "1a"])
def test_table_names_are_checked(table):
    with pytest.raises(ValueError, match="table"):
        JdbcSource("jdbc:x://h/d", table)


def test_range_statement(spark):
    assert range_query(spark, SOURCE) == 'SELECT MIN("ts") AS oldest, MAX("ts") AS newest FROM db.sensors'
    assert range_query(spark, SOURCE, 1_704_067_200_000_000).endswith(
        """FROM db.sensors WHERE "ts" >= '2024-01-01 00:00:00'"""
    )


@pytest.mark.parametrize(
    "url, name, literal",
    [
        ("jdbc:TAOS-RS://h:6041/d", '"at`t""s"', "'2024-01-01 00:00:00.000123'"),
        ("jdbc:mysql://h/d", '`at``t"s`', "'2024-01-01 00:00:00.000123'"),
        ("jdbc:postgresql://h/d", '"at`t""s"', "'2024-01-01 00:00:00.000123'"),
        ("jdbc:databricks://h", '`at``t"s`', "'2024-01-01 00:00:00.000123'"),
        ("jdbc:oracle:thin:@h:1521/x", '"at`t""s"', "{ts '2024-01-01 00:00:00.000123'}"),
    ],
)
def test_names_and_instants_follow_the_address(spark, url, name, literal):
    source = JdbcSource(url, "t", ts_col='at`t"s')
    lo = 1_704_067_200_000_123
    later = literal.replace("00:00:00.000123", "01:00:00.000123")
    assert slice_conditions(spark, source, [TimeRange(lo, lo + 3_600_000_000)]) == [f"{name} >= {literal} AND {name} < {later}"]
    assert range_query(spark, source, None, lo) == f"SELECT MIN({name}) AS oldest, MAX({name}) AS newest FROM t WHERE {name} < {literal}"


def test_explicit_range_needs_no_connection(spark):
    rng = find_jdbc_range(spark, SOURCE, "2024-01-01 00:00:00.0005", "2024-01-02 00:00:00")
    assert rng == TimeRange(1_704_067_200_000_500, 1_704_153_600_000_000)
    assert find_jdbc_range(spark, SOURCE, "2024-01-01 00:00:00.0005", "2024-01-02 00:00:00", compat=True).lo_us % 1000 == 0


def test_predicates_cut_a_table_into_disjoint_parts(spark, events):
    source = JdbcSource("jdbc:x://h/d", "t", quote="`")
    predicates = slice_conditions(spark, source, slice_ranges(find_range(events), 7))
    counts = [events.where(p).count() for p in predicates]
    assert len(counts) == 7 and sum(counts) == events.count() and all(counts)
    assert events.where(" OR ".join(f"({p})" for p in predicates)).count() == events.count()


def test_predicates_keep_microseconds_at_the_outer_edges(spark):
    df = instants(spark, ["2024-01-01 00:00:00.000123", "2024-01-01 00:00:00.000999"])
    source = JdbcSource("jdbc:x://h/d", "t", quote="`", literal="TIMESTAMP'{}'")
    predicates = slice_conditions(spark, source, slice_ranges(find_range(df), 4))
    assert predicates[0].startswith("`ts` >= TIMESTAMP'2024-01-01 00:00:00.000123'")
    assert sum(df.where(p).count() for p in predicates) == 2


def test_even_slices_split_a_dense_stretch(spark, events, monkeypatch):
    # A third of the rows fall into one hour of the month.
    dense = events.where("event_id % 3 = 0").selectExpr("TIMESTAMP_NTZ'2024-01-20 10:00:00' + make_dt_interval(0, 0, 0, CAST(event_id AS INT) * 2) AS ts")
    rows = events.where("event_id % 3 <> 0").select("ts").union(dense).cache()
    rows.createOrReplaceTempView("dense_rows")
    source = JdbcSource("jdbc:x://h/d", "dense_rows", quote="`")
    monkeypatch.setattr(jdbc, "_load", lambda spark, source, statement: spark.sql(statement))
    rng = find_range(rows)
    slices = [slice_ranges(rng, 6), jdbc.even_jdbc_slices(spark, source, rng, 6)]
    equal, even = ([rows.where(p).count() for p in slice_conditions(spark, source, s)] for s in slices)
    assert [jdbc.slice_rows(spark, source, s) for s in slices] == [equal, even]
    assert sum(equal) == sum(even) == events.count()
    assert max(even) < max(equal)


def test_even_slices_leave_nothing_out():
    counted = [(i * 10, i * 10 + 10, rows) for i, rows in enumerate([0, 0, 5, 100, 1, 1, 0, 7, 0])]
    slices = even_slices(counted, 4)
    assert slices[0].lo_us == 0 and slices[-1].hi_us == 90
    assert all(a.hi_us == b.lo_us for a, b in zip(slices, slices[1:]))
    assert TimeRange(30, 40) in slices
    assert even_slices([(0, 10, 0)], 4) == [TimeRange(0, 10)]
    assert even_slices([], 4) == []


def test_unreadable_bounds_are_errors(spark):
    with pytest.raises(ValueError, match="start"):
        find_jdbc_range(spark, SOURCE, "sometime", "2024-01-20")


def test_range_statement_gives_the_range(spark, events, monkeypatch):
    events.createOrReplaceTempView("some_events")
    monkeypatch.setattr(jdbc, "_load", lambda spark, source, statement: spark.sql(statement))
    source = JdbcSource("jdbc:x://h/d", "some_events", quote="`")
    for bounds in ((None, None), ("2024-01-05 00:00:00", None), (None, "2024-01-20 00:00:00"), ("x", "2024-01-20 00:00:00")):
        for compat in (False, True):
            assert find_jdbc_range(spark, source, *bounds, compat, True) == find_range(events, "ts", *bounds, compat, True)
    assert find_jdbc_range(spark, source, "2031-01-01 00:00:00") is None


def test_counts_are_one_job(spark, events, monkeypatch):
    events.createOrReplaceTempView("counted_events")
    source = JdbcSource("jdbc:x://h/d", "counted_events", quote="`")
    statements = []

    def load(spark, source, statement):
        statements.append(statement)
        return spark.range(1).selectExpr("CAST(0 AS INT) AS place", "7L AS held").where(f"{len(statements)} = 1")

    monkeypatch.setattr(jdbc, "_load", load)
    slices = slice_ranges(find_range(events), 300)
    spark.sparkContext.setJobGroup("counts", "counts")
    assert jdbc.slice_rows(spark, source, slices) == [7, *[0] * 299]
    assert len(statements) == 3 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("counts")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
