import pytest
from support import instants, plan_of
from pyspark.sql import functions as F

from chronoferry.operators.ranges import TimeRange, find_range, in_range, parse_bounds, range_frame

DAY = 86_400_000_000
T0 = 1_704_067_200_000_000  # 2024-01-01 00:00:00


def us(spark, text):
    return parse_bounds(spark, text, None)[0]


def test_found_end_keeps_the_newest_row(spark):
    df = instants(spark, ["2024-01-01 00:00:00", "2024-01-02 00:00:00.000001"])
    rng = find_range(df)
    assert rng == TimeRange(T0, T0 + DAY + 2)
    assert in_range(df, rng).count() == 2


def test_compat_loses_the_newest_row_and_cuts_to_milliseconds(spark):
    df = instants(spark, ["2024-01-01 00:00:00.000900", "2024-01-02 00:00:00.000800"])
    rng = find_range(df, compat=True)
    assert rng == TimeRange(T0, T0 + DAY)
    assert in_range(df, rng).count() == 1


def test_one_instant(spark):
    df = instants(spark, ["2024-01-01 00:00:00"])
    assert in_range(df, find_range(df)).count() == 1
    assert in_range(df, find_range(df, compat=True)).count() == 0


def test_explicit_bounds_are_not_clamped_and_read_nothing(spark):
    df = instants(spark, ["2024-01-01 00:00:00"])
    frame = range_frame(df, start="2020-01-01 00:00:00", end="2030-01-01 00:00:00.5")
    assert "Scan ExistingRDD" not in plan_of(frame) and "Exchange" not in plan_of(frame)
    assert find_range(df, start="2020-01-01 00:00:00", end="2030-01-01 00:00:00.5") == TimeRange(
        us(spark, "2020-01-01 00:00:00"), us(spark, "2030-01-01 00:00:00.5")
    )


def test_row_at_start_is_in_and_row_at_end_is_out(spark):
    df = instants(spark, ["2024-01-01 00:00:00", "2024-01-02 00:00:00"])
    rng = find_range(df, start="2024-01-01 00:00:00", end="2024-01-02 00:00:00")
    assert [r.ts.day for r in in_range(df, rng).collect()] == [1]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2024-01-02 00:00:00", None, (DAY, 2 * DAY + 1)),
        (None, "2024-01-03 00:00:00", (0, DAY + 1)),
        ("2024-01-02 00:00:00", "nonsense", (DAY, 2 * DAY + 1)),
        ("2024-01-02", "2024-01-03 00:00:00", (DAY, 2 * DAY)),
        ("nonsense", "nonsense", (0, 2 * DAY + 1)),
        ("2025-01-01 00:00:00", None, None),
        (None, "2023-01-01 00:00:00", None),
        ("2025-01-01 00:00:00", "nonsense", None),
    ],
)
def test_one_readable_bound(spark, start, end, expected):
    df = instants(spark, ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"])
    rng = find_range(df, start=start, end=end, lenient=True)
    assert rng == (None if expected is None else TimeRange(T0 + expected[0], T0 + expected[1]))
    assert range_frame(df, start=start, end=end, lenient=True).count() == (0 if expected is None else 1)


def test_empty_table_and_nulls(spark):
    empty = instants(spark, ["2024-01-01 00:00:00"]).where("false")
    assert find_range(empty) is None
    assert in_range(empty, None).count() == 0
    nulls = instants(spark, [None, "2024-01-01 00:00:00", None])
    assert find_range(nulls) == TimeRange(T0, T0 + 1)


def test_reversed_bounds_give_no_rows(spark):
    df = instants(spark, ["2024-01-01 00:00:00"])
    rng = find_range(df, start="2024-02-01 00:00:00", end="2023-01-01 00:00:00")
    assert rng.lo_us > rng.hi_us
    assert in_range(df, rng).count() == 0


def test_before_1970(spark):
    df = instants(spark, ["1969-12-31 23:59:59.9995"])
    assert find_range(df) == TimeRange(-500, -499)


def test_text_time_column(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("garbage",), (None,), ("2024-01-02",)], "ts string")
    assert find_range(df) == TimeRange(T0, T0 + 1)


def test_time_column_name_is_exact(spark):
    df = instants(spark, ["2024-01-01 00:00:00"]).withColumnRenamed("ts", "TS")
    with pytest.raises(ValueError, match="exactly"):
        find_range(df)
    with pytest.raises(ValueError, match="type"):
        find_range(spark.range(3), "id")


def test_filter_reaches_the_scan(events):
    rng = find_range(events, start="2024-01-08 00:00:00", end="2024-01-15 00:00:00")
    plan = plan_of(in_range(events, rng).select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_range_reads_the_time_column_only(events):
    plan = plan_of(range_frame(events))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan and "partial_min" in plan


def test_session_zone_applies_to_bounds_and_wall_clock_columns(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        wall = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 09:00:00' AS ts")
        assert find_range(wall) == TimeRange(T0, T0 + 1)
        assert us(spark, "2024-01-01 09:00:00") == T0
        assert in_range(wall, find_range(wall)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bounds_with_other_columns_filtered_later(events):
    rng = find_range(events.where(F.col("event_type") == "view"))
    assert rng is not None and rng.lo_us < rng.hi_us


def test_bounds_fail_closed(spark):
    df = instants(spark, ["2024-01-01 00:00:00", "2024-01-03 00:00:00"])
    with pytest.raises(ValueError, match="end"):
        find_range(df, start="2024-01-01", end="2024-1-25T99:00:00")
    assert find_range(df, start="2024-01-02", end="no time", lenient=True) == TimeRange(T0 + 2 * DAY, T0 + 2 * DAY + 1)
    assert find_range(df, start="2024-01-02", end="2024-01-02T12:00:00") == TimeRange(T0 + DAY, T0 + DAY + DAY // 2)
    assert find_range(df, start=" ", end="") == find_range(df)
