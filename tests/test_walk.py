"""Walking a table page by page."""

import random

import pytest
from pyspark.sql import functions as F
from support import SMALL, instants, plan_of

from chronoferry.operators import paging
from chronoferry.operators.ranges import find_range
from chronoferry.operators.walk import PageToken, page_after
from chronoferry.plans import queries

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def walk(df, ts_col, keys, limit, most=200):
    """All pages as lists of (time, keys), the token being text in between."""
    rng, token, pages = find_range(df, ts_col), None, []
    for _ in range(most):
        page, token = page_after(df, rng, ts_col, keys, limit, token)
        pages.append(sorted(tuple((v is not None, v) for v in r) for r in page.select(ts_col, *keys).collect()))
        if token is None:
            return pages
        token = PageToken.parse(token.text())
    raise AssertionError("no end")


@pytest.mark.parametrize("limit", [700, 6000, 100_000])
def test_pages_are_those_of_the_whole_order(lineitem, limit):
    pages = walk(lineitem, "l_shipdate", KEYS, limit)
    rows = sorted(tuple((v is not None, v) for v in r) for r in lineitem.select("l_shipdate", *KEYS).collect())
    assert [r for p in pages for r in p] == rows
    assert all(len(p) == limit for p in pages[:-1]) and 0 < len(pages[-1]) <= limit


def test_gaps_ties_and_null_keys(spark):
    rnd = random.Random(2)
    times = ["2024-01-01 00:00:00"] * 7 + ["2024-01-01 00:00:00.000001"] * 3 + ["2024-06-01 00:00:00"] * 5 + ["2024-06-02 00:00:00"]
    rnd.shuffle(times)
    df = instants(spark, times, k=list(range(len(times))))
    df = df.withColumn("word", F.when(F.col("k") % 3 > 0, F.concat(F.lit("w'"), (F.col("k") % 3).cast("string"))))
    for limit in (1, 3, 4, 16, 17):
        pages = walk(df, "ts", ["word", "k"], limit)
        rows = sorted(tuple((v is not None, v) for v in r) for r in df.select("ts", "word", "k").collect())
        assert [r for p in pages for r in p] == rows


def test_rows_that_nothing_tells_apart_come_together(spark):
    df = instants(spark, ["2024-01-01 00:00:00"] * 5 + ["2024-01-02 00:00:00"], k=[1] * 6)
    assert [len(p) for p in walk(df, "ts", ["k"], 2)] == [5, 1]


def test_a_page_reads_a_pruned_range(lineitem):
    rng = find_range(lineitem, "l_shipdate")
    page, token = page_after(lineitem, rng, "l_shipdate", KEYS, 500)
    page, token = page_after(lineitem, rng, "l_shipdate", KEYS, 500, token)
    plan = plan_of(page)
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "Sort" not in plan and "Exchange" not in plan


def test_an_empty_range_has_no_pages(events):
    page, token = page_after(events, None, "ts", ["event_id"])
    assert page.count() == 0 and token is None


def test_keys_need_a_text(spark):
    df = instants(spark, ["2024-01-01 00:00:00"], k=[1]).withColumn("k", F.array("k"))
    with pytest.raises(ValueError, match="text"):
        page_after(df, find_range(df), "ts", ["k"])


def strides(df, ts_col, keys, limit, pages):
    """The rows of every page, `pages` of them at a time."""
    rng, token, found = find_range(df, ts_col), None, []
    while not found or token is not None:
        rows, token = page_after(df, rng, ts_col, keys, limit, token, pages)
        part = {}
        for page_no, *row in rows.select("page_no", ts_col, *keys).collect():
            part.setdefault(page_no, []).append(tuple((v is not None, v) for v in row))
        assert sorted(part) == list(range(len(part))) and (token is None or len(part) == pages)
        found += [sorted(part[k]) for k in sorted(part)]
        token = token and PageToken.parse(token.text())
    return found


@pytest.mark.parametrize("limit, pages", [(700, 3), (700, 1000), (100, 17)])
def test_many_pages_at_once_are_those_of_the_walk(lineitem, limit, pages):
    rows = sorted(tuple((v is not None, v) for v in r) for r in lineitem.select("l_shipdate", *KEYS).collect())
    assert strides(lineitem, "l_shipdate", KEYS, limit, pages) == [rows[k : k + limit] for k in range(0, len(rows), limit)]


@pytest.mark.parametrize("group_rows", [50_000, 7])
def test_many_pages_at_once_keep_rows_together_that_nothing_tells_apart(spark, monkeypatch, group_rows):
    monkeypatch.setattr(paging, "GROUP_ROWS", group_rows)
    rnd = random.Random(5)
    days = sorted(rnd.choices(range(1, 29), k=150))
    df = instants(spark, [f"2024-01-{d:02d} 00:00:00" for d in days], k=[rnd.randrange(3) for _ in days])
    df = df.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    rows = sorted(tuple((v is not None, v) for v in r) for r in df.select("ts", "k").collect())
    expected = [[]]
    for row in rows:
        if len(expected[-1]) >= 7 and expected[-1][-1] != row:
            expected.append([])
        expected[-1].append(row)
    assert strides(df, "ts", ["k"], 7, 10) == expected


def test_many_pages_of_one_instant(spark):
    df = instants(spark, ["2024-01-01 00:00:00"] * 10, k=list(range(10)))
    assert [len(p) for p in strides(df, "ts", ["k"], 4, 1)] == [4, 4, 2]
    empty, token = page_after(df, None, "ts", ["k"], 4, None, 3)
    assert empty.columns == ["ts", "k", "page_no"] and empty.count() == 0 and token is None


def test_the_jobs_of_a_walk_do_not_grow_with_its_pages(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(queries.walk, "page_after", lambda *a: calls.append(a) or page_after(*a))
    monkeypatch.setattr(queries, "WALK_ROWS", 50)
    pages = queries.QUERIES["page_walk"](spark, SMALL)
    assert pages.count() > 50 and len(calls) <= queries.WALK_STRIDES + 1
