import re
from collections import Counter

import pytest
from support import instants, plan_of
from pyspark.sql import functions as F

from chronoferry.operators import paging
from chronoferry.operators.paging import explode_batches, fetch_page, number_rows, page_batches, page_index
from chronoferry.operators.ranges import find_range



@pytest.fixture(autouse=True, params=[paging.GROUP_ROWS, 40])
def group_rows(request, monkeypatch):
    """Everything with slices of one group and with slices of many."""
    monkeypatch.setattr(paging, "GROUP_ROWS", request.param)
    return request.param


KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def test_ties_around_a_page_edge(spark):
    texts = ["2024-01-01 00:00:00", *["2024-01-01 00:00:01"] * 5, "2024-01-01 00:00:02"]
    df = instants(spark, texts, key=[9, 5, 3, 1, 4, 2, 0])
    rows = number_rows(df, find_range(df), "ts", ["key"], 1, 3).orderBy("rn").collect()
    assert [(r.key, r.rn, r.page_no) for r in rows] == [
        (9, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 1), (4, 4, 1), (5, 5, 1), (0, 6, 2),
    ]


def test_pages_by_hand(lineitem):
    rng = find_range(lineitem, "l_shipdate")
    rows = lineitem.select(F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("us"), *KEYS).collect()
    origin, n = rng.lo_us // 1000, 5
    stride = (rng.hi_us // 1000 - origin) // n
    slices = {}
    for r in sorted(rows):
        slices.setdefault(min((r.us // 1000 - origin) // stride, n - 1), []).append(r.us // 1000)
    expected = {
        (part, k // 70): (len(ms[k : k + 70]), ms[k], ms[k : k + 70][-1])
        for part, ms in slices.items()
        for k in range(0, len(ms), 70)
    }
    index = page_index(lineitem, rng, "l_shipdate", KEYS, n, 70)
    assert {(r.part_id, r.page_no): (r.n, r.first_ms, r.last_ms) for r in index.collect()} == expected


def test_one_instant_holding_all_rows_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(paging, "GROUP_ROWS", 500)
    df = spark.range(0, 20_000, numPartitions=8).select(
        F.timestamp_seconds(F.lit(1_704_067_200)).alias("ts"), F.hash("id").alias("mix"), "id"
    )
    numbered = number_rows(df, find_range(df), "ts", ["mix", "id"], 8, 100)
    index = Counter(r.page_no for r in numbered.collect())
    assert len(index) == 200 and set(index.values()) == {100}
    runs = numbered.select(F.col("rn")).agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(runs) == (0, 19_999, 20_000)
    narrow = paging._rows(df, find_range(df), "ts", ["mix", "id"], 8)
    sizes = paging._grouped(narrow, paging._sampled_guide(narrow)).groupBy("s", "g").count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) < 20_000 / 8


def test_fetched_pages_by_hand(lineitem):
    narrow = lineitem.select("l_shipdate", *KEYS)
    rng = find_range(lineitem, "l_shipdate")
    rows = sorted(map(tuple, narrow.collect()))
    for offset in (0, 777, len(rows) - 70, len(rows)):
        page = fetch_page(narrow, rng, "l_shipdate", KEYS, 150, offset)
        assert sorted(map(tuple, page.collect())) == rows[offset : offset + 150]


def test_a_page_reads_only_its_slices(lineitem):
    rng = find_range(lineitem, "l_shipdate")
    page = fetch_page(lineitem, rng, "l_shipdate", KEYS, 10, 5_000)
    plan = plan_of(page)
    assert "LessThan(l_shipdate" in plan and page.columns == lineitem.columns


def test_page_of_an_instant_that_holds_everything(spark):
    df = spark.range(1_000).select(F.timestamp_seconds(F.lit(0)).alias("ts"), "id")
    page = fetch_page(df, find_range(df), "ts", ["id"], 10, 500)
    assert sorted(r.id for r in page.collect()) == list(range(500, 510))


def test_batches_hold_ordered_records_and_explode_to_the_scan(events):
    rng = find_range(events)
    batches = page_batches(events, rng, "ts", ["event_id"], 4, 30)
    for r in batches.collect():
        times = [b["ts"] for b in r.batch]
        assert 0 < len(times) <= 30 and times == sorted(times)
    again = explode_batches(batches)
    assert again.columns == events.columns
    assert again.exceptAll(events).count() == 0 and again.count() == events.count()


def test_columns_named_like_helpers_are_left_alone(spark):
    names = ["rn", "_pos", "_run", "page_no", "part_id", "s", "o", "r", "g"]
    df = spark.range(500).select(F.timestamp_seconds("id").alias("ts"), "id", *(F.lit(-k).alias(n) for k, n in enumerate(names)))
    rng = find_range(df)
    again = explode_batches(page_batches(df, rng, "ts", ["id"], 2, 30))
    page = fetch_page(df, rng, "ts", ["id"], 20, 100)
    for rows, n in ((again, 500), (page, 20)):
        assert rows.columns == df.columns and rows.count() == n and rows.exceptAll(df).count() == 0
    with pytest.raises(ValueError, match="page_no"):
        number_rows(df, rng, "ts", ["id"], 2, 30)


def test_whole_rows_move_once_for_batches(events):
    plan = plan_of(page_batches(events, find_range(events), "ts", ["event_id"], 4, 30))
    plan = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert len(re.findall(r"\bExchange ", plan)) == 1


def test_keys_are_required(events):
    with pytest.raises(ValueError, match="keys"):
        page_index(events, find_range(events))


def test_empty_range_has_no_pages(events):
    assert page_index(events, None, "ts", ["event_id"]).count() == 0
