import random

import pytest
from pyspark.sql import functions as F
from support import instants, plan_of

from chronoferry.operators.merge import find_packing, merge_points
from chronoferry.operators.points import to_points

SECONDS = [f"2024-01-01 00:00:0{i}" for i in range(4)]


def built(df, *order):
    return to_points(df, "m", carry=order, ignore=order)


@pytest.mark.parametrize(
    "order", [("seq",), ("major", "minor"), ("word", "seq"), ("huge", "minor"), ("far", "minor"), ("day", "minor")]
)
def test_merge_by_hand(spark, order):
    rnd = random.Random(3)
    rows = [
        (rnd.choice(SECONDS), rnd.choice(["a", "b", "", None]), i, rnd.choice([None, i * 1.5]), rnd.choice([None, i]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "ts string, tag string, seq bigint, v double, n bigint")
    # The same order as whole numbers, text, numbers that need more than 64 and more than 126 bits, and dates
    # or no date at all, which comes first.
    df = df.selectExpr(
        "*",
        "seq div 7 AS major",
        "CAST(seq % 7 AS INT) AS minor",
        "lpad(seq div 7, 3, '0') AS word",
        "(seq div 7 - 20) * 200000000000000000 AS huge",
        "CASE WHEN seq < 200 THEN seq div 7 - 9223372036854775807 ELSE 9223372036854775000 + seq div 7 END AS far",
        "CASE WHEN seq >= 7 THEN date_add(DATE'1969-12-20', CAST(seq div 7 AS INT)) END AS day",
    )
    df = df.drop(*({"seq", "major", "minor", "word", "huge", "far", "day"} - set(order)))
    expected = {}
    for ts, tag, _, v, n in rows:
        old = expected.get((ts, tag or None), (None, None, 0))
        expected[ts, tag or None] = (old[0] if v is None else v, old[1] if n is None else n, old[2] + 1)
    got = {
        (SECONDS[r.ts_ms // 1000 % 60], r.tags.tag): (r.fields.v, r.fields.n, r.merged_rows)
        for r in merge_points(built(df.repartition(8), *order)).collect()
    }
    assert got == expected


def test_a_repeated_copy_changes_nothing(lineitem):
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    points = to_points(lineitem, "m", "l_shipdate", carry=keys)
    once, twice = merge_points(points), merge_points(points.union(points))
    assert once.drop("merged_rows").exceptAll(twice.drop("merged_rows")).count() == 0
    assert once.count() == twice.count()
    assert twice.agg(F.sum("merged_rows")).first()[0] == 2 * lineitem.count()


def test_merging_within_milliseconds(spark):
    df = instants(spark, ["2024-01-01 00:00:00.000100", "2024-01-01 00:00:00.000900"], seq=[1, 2], v=[1.0, 2.0])
    (row,) = merge_points(built(df, "seq")).collect()
    assert row.fields.v == 2.0 and row.merged_rows == 2


def test_one_identity_with_most_rows_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 50_000, numPartitions=8).select(
        F.timestamp_seconds(F.lit(0)).alias("ts"), F.lit("hot").alias("tag"), "id", (F.col("id") * 2.0).alias("v")
    )
    merged = merge_points(built(df, "id"))
    plan = plan_of(merged)
    assert "partial_max_by" in plan and "SortAggregate" not in plan
    (row,) = merged.collect()
    assert row.fields.v == 99_998.0 and row.merged_rows == 50_000


def test_an_order_is_required(events):
    with pytest.raises(ValueError, match="order"):
        merge_points(to_points(events, "events"))


def test_points_without_tags(spark):
    df = instants(spark, [SECONDS[0], SECONDS[0]], seq=[1, 2], v=[1.0, 2.0])
    (row,) = merge_points(built(df, "seq")).collect()
    assert row.fields.v == 2.0


def test_packed_orders_need_no_sort(spark, lineitem):
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    points = to_points(lineitem, "m", "l_shipdate", carry=keys)
    plan = plan_of(merge_points(points))
    assert "Sort" not in plan and plan.count("Exchange") == 1
    assert find_packing(to_points(lineitem, "m", "l_shipdate", carry=("l_orderkey", "l_returnflag"))) is None
    assert find_packing(to_points(lineitem, "m", "l_shipdate", carry=("l_orderkey",))) is None


def test_orders_beyond_any_number_are_compared_as_they_are(spark):
    ends = [-(2**63), 2**63 - 1]
    df = instants(spark, [SECONDS[0]] * 4, a=[ends[0], ends[0], ends[1], ends[1]], b=[ends[0], ends[1], ends[0], ends[1]],
                  v=[1.0, 2.0, 3.0, 4.0])
    points = built(df, "a", "b")
    assert find_packing(points) is None
    assert merge_points(points).first().fields.v == 4.0


def test_an_empty_table_merges_to_nothing(spark):
    df = spark.createDataFrame([], "ts timestamp, a bigint, b int, v double")
    assert merge_points(built(df, "a", "b")).count() == 0


def test_numbers_beside_points_are_added_up(spark):
    df = instants(spark, [SECONDS[0], SECONDS[0], SECONDS[1]], seq=[1, 2, 3], v=[1.0, 2.0, 3.0])
    points = to_points(df, "m", carry=("seq",), beside={"lost": F.col("seq") * 10})
    assert sorted((r.merged_rows, r.beside.lost) for r in merge_points(points).collect()) == [(1, 30), (2, 30)]
