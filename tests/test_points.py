import datetime as dt
import json
from decimal import Decimal

import pytest
from support import instants, plan_of

from chronoferry.functions.line import to_lines
from chronoferry.operators.points import (
    explode_points,
    field_count,
    layout_of,
    lost_values,
    point_maps,
    rejected_rows,
    to_points,
)

UTC = dt.timezone.utc
AT = dt.datetime(2024, 1, 1, tzinfo=UTC)

TYPED = (
    "ts timestamp, b tinyint, s smallint, i int, l bigint, f float, d double, dec decimal(12,2), "
    "big decimal(38,0), str string, bin binary, flag boolean, ts2 timestamp, day date"
)


@pytest.fixture(scope="module")
def typed(spark):
    values = (
        AT, 1, 2, 3, 4, 0.1, 0.1, Decimal("12.99"), Decimal(7), "text", b"bytes", True,
        AT, dt.date(2024, 2, 29),
    )
    return spark.createDataFrame([values, (AT, *[None] * 13)], TYPED)


def test_type_rules(typed):
    full, _ = to_points(typed, "m").orderBy("fields.i", ascending=False).collect()
    assert full.measurement == "m" and full.ts_ms == 1_704_067_200_000
    assert full.tags.asDict() == {
        "bin": "bytes",
        "day": "2024-02-29",
        "flag": "true",
        "str": "text",
        "ts2": "2024-01-01 00:00:00.0",
    }
    assert full.fields.asDict() == {
        "b": 1, "big": 7, "d": 0.1, "dec": 12, "f": 0.10000000149011612, "i": 3, "l": 4, "s": 2,
    }


def test_a_row_of_nulls_is_a_point_without_a_line(typed):
    points = to_points(typed.where("str is null"), "m")
    assert points.count() == 1
    assert points.select(field_count(points)).first()[0] == 0
    assert explode_points(points).count() == 0
    assert to_lines(points).count() == 0
    maps = point_maps(points).first()
    assert (maps.tags, maps.fields_f64, maps.fields_i64) == ({}, {}, {})


def test_map_form(typed):
    row = point_maps(to_points(typed.where("str is not null"), "m")).first()
    assert row.tags["str"] == "text" and row.fields_i64["dec"] == 12 and row.fields_f64 == {
        "d": 0.1,
        "f": 0.10000000149011612,
    }


def test_long_form(typed):
    rows = explode_points(to_points(typed.where("str is not null"), "m")).collect()
    assert len(rows) == 13
    by_key = {r.key: r for r in rows}
    assert by_key["flag"].kind == "tag" and by_key["flag"].s == "true"
    assert by_key["f"].kind == "f64" and by_key["l"].kind == "i64" and by_key["l"].i == 4


def test_bad_bytes_are_replaced(spark):
    df = spark.createDataFrame(
        [(AT, "ü".encode(), 0), (AT, b"", 1), (AT, b"a\xffb", 2)], "ts timestamp, bin binary, n int"
    )
    tags = {r.fields.n: r.tags.bin for r in to_points(df, "m").collect()}
    assert tags == {0: "ü", 1: "", 2: "a�b"}


def test_decimals_lose_fraction_and_overflow(spark):
    values = ["12.99", "-12.99", "0.00", "92233720368547758080", "-92233720368547758080", None]
    df = spark.createDataFrame([(AT, v and Decimal(v)) for v in values], "ts timestamp, dec decimal(24,2)")
    assert [r.fields.dec for r in to_points(df, "m").collect()] == [12, -12, 0, None, None, None]
    assert [r[0] for r in df.select(lost_values(df)).collect()] == [0, 0, 0, 1, 1, 0]
    assert to_points(df, "m", decimal="double").first().fields.dec == 12.99


def test_timestamp_tags(spark):
    times = [AT.replace(microsecond=m) for m in (0, 500_000, 120, 1)]
    df = spark.createDataFrame([(AT, t, i) for i, t in enumerate(times)], "ts timestamp, at timestamp, n int")
    df = df.withColumn("wall", df["at"].cast("timestamp_ntz"))
    rows = to_points(df, "m").orderBy("fields.n").collect()
    assert [r.tags.at[20:] for r in rows] == ["0", "5", "00012", "000001"]
    assert all(r.tags.at == r.tags.wall for r in rows)


def test_nested_columns(spark):
    df = spark.createDataFrame([(AT, [1, 2])], "ts timestamp, list array<int>")
    assert to_points(df, "m").first().tags.list == "[1,2]"
    with pytest.raises(ValueError, match="nested"):
        to_points(df, "m", nested="reject")


def test_null_times_are_rejected(spark):
    df = instants(spark, ["2024-01-01 00:00:00", None], v=[1.5, 2.5])
    assert [r.fields.v for r in to_points(df, "m").collect()] == [1.5]
    (reject,) = rejected_rows(df).collect()
    assert reject.reason == "time is null" and json.loads(reject.row_json) == {"ts": None, "v": 2.5}


def test_text_times(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00.5", 1), ("garbage", 2), ("2024-01-01", 3), (None, 4)], "ts string, v int"
    )
    assert [(r.ts_ms, r.fields.v) for r in to_points(df, "m").collect()] == [(1_704_067_200_500, 1)]
    assert sorted((r.reason, json.loads(r.row_json)["v"]) for r in rejected_rows(df).collect()) == [
        ("time is not a timestamp", 2),
        ("time is not a timestamp", 3),
        ("time is null", 4),
    ]


def test_every_row_is_a_point_or_a_reject(events):
    from pyspark.sql import functions as F

    df = events.withColumn("ts", F.when(F.col("user_id") > 50, F.col("ts")))
    assert to_points(df, "m").count() + rejected_rows(df).count() == df.count()


def test_milliseconds_floor_before_1970(spark):
    df = instants(spark, ["1969-12-31 23:59:59.9995"], v=[1])
    assert to_points(df, "m").first().ts_ms == -1


def test_odd_column_names(spark):
    df = spark.createDataFrame([(AT, "x", 1)], "ts timestamp, `a.b` string, `c``d e` int")
    point = to_points(df, "m").first()
    assert point.tags["a.b"] == "x" and point.fields["c`d e"] == 1
    assert to_lines(to_points(df, "m")).first().line == "m,a.b=x c`d\\ e=1i 1704067200000"


def test_layout_and_duplicate_names(spark):
    df = spark.createDataFrame([(AT, 1, "x")], "ts timestamp, z int, a string")
    layout = layout_of(df)
    assert (layout.tags, layout.fields) == (("a",), ("z",))
    with pytest.raises(ValueError, match="repeat"):
        layout_of(df.select("ts", "a", "a"))


def test_conversion_is_one_stage_in_generated_code(events):
    plan = plan_of(to_lines(to_points(events, "events")))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.strip().startswith("*(1) Project")


def test_unused_columns_are_not_read(events):
    plan = plan_of(to_points(events, "events").select("ts_ms", "fields.value"))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
