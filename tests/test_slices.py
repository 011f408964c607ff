import random

from pyspark.sql import functions as F
from support import instants, plan_of

from chronoferry.operators.ranges import TimeRange, between, find_range
from chronoferry.operators.slices import place_of, slice_counts, slice_of, slice_ranges, time_slices, weighted_slices

HOUR = 3_600_000_000


def expected_edges(rng, n):
    """The same edges by hand: whole milliseconds inside, exact ends outside."""
    lo_ms, hi_ms = rng.lo_us // 1000, rng.hi_us // 1000
    stride = int((hi_ms - lo_ms) / n)
    inner = [min(max((lo_ms + i * stride) * 1000, rng.lo_us), rng.hi_us) for i in range(1, n)]
    return list(zip([rng.lo_us, *inner], [*inner, rng.hi_us]))


def test_edges_cover_the_range_without_gap_or_overlap(spark):
    rnd = random.Random(7)
    for _ in range(12):
        lo = rnd.randrange(-(10**15), 10**15)
        rng, n = TimeRange(lo, lo + rnd.randrange(1, 10 ** rnd.randrange(2, 16))), rnd.randrange(1, 40)
        rows = time_slices(spark, rng, n).orderBy("part_id").collect()
        edges = [(r.lo_us, r.hi_us) for r in rows]
        assert edges == expected_edges(rng, n)
        assert edges[0][0] == rng.lo_us and edges[-1][1] == rng.hi_us
        assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
        assert all(a <= b for a, b in edges)


def test_every_instant_lies_in_the_slice_it_is_given(spark):
    rnd = random.Random(11)
    for _ in range(6):
        lo = rnd.randrange(-(10**12), 10**15)
        width, n = rnd.randrange(1, 10 ** rnd.randrange(3, 15)), rnd.randrange(1, 20)
        rng = TimeRange(lo, lo + width)
        edges = expected_edges(rng, n)
        times = [lo, lo + width - 1, *(e for pair in edges for e in pair if e < rng.hi_us)]
        times += [rnd.randrange(lo, lo + width) for _ in range(200)]
        rows = (
            spark.createDataFrame([(t,) for t in times], "us bigint")
            .select("us", slice_of(F.col("us"), rng, n).alias("part"))
            .collect()
        )
        for r in rows:
            assert edges[r.part][0] <= r.us < edges[r.part][1]


def test_range_shorter_than_the_slices(spark):
    rng = TimeRange(5_000, 10_000)
    rows = time_slices(spark, rng, 8).orderBy("part_id").collect()
    assert [r.hi_us - r.lo_us for r in rows] == [0] * 7 + [5_000]
    df = spark.range(5_000, 10_000, 500).select(F.timestamp_micros("id").alias("ts"))
    assert [(r.part_id, r.n) for r in slice_counts(df, rng, "ts", 8).collect()] == [(7, 10)]


def test_reversed_range_has_empty_slices(spark):
    rows = time_slices(spark, TimeRange(HOUR, 0), 4).collect()
    assert all(r.lo_us >= r.hi_us for r in rows)


def test_no_range_no_slices(spark):
    assert time_slices(spark, None, 8).count() == 0


def test_counts_are_reduced_before_the_shuffle(lineitem):
    plan = plan_of(slice_counts(lineitem, TimeRange(0, 10**16), "l_shipdate", 8))
    assert "partial_count" in plan and plan.count("Exchange") == 1


def test_slices_on_the_driver_are_those_of_the_table(spark, events):
    for df, n in ((events, 7), (events, 1), (instants(spark, ["2024-01-01 00:00:00.000100", "2024-01-01 00:00:00.003"]), 8)):
        rng = find_range(df)
        rows = time_slices(spark, rng, n).orderBy("part_id").collect()
        assert [(r.lo_us, r.hi_us) for r in rows] == [(s.lo_us, s.hi_us) for s in slice_ranges(rng, n)]


def test_weighted_slices(spark):
    """Two thirds of the rows lie in a thousandth of the range."""
    us = F.when(F.col("id") % 3 == 0, F.col("id") * 1_000_000).otherwise(5_000_000_000 + F.col("id") * 700)
    df = spark.range(0, 30_000, numPartitions=16).select(F.timestamp_micros(us).alias("ts"))
    rng = find_range(df)
    for n in (1, 8, 50):
        spark.sparkContext.setJobGroup(f"weighted {n}", "")
        slices = weighted_slices(df, rng, "ts", n)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"weighted {n}")) <= 2
        assert len(slices) == n and (slices[0].lo_us, slices[-1].hi_us) == (rng.lo_us, rng.hi_us)
        assert all(a.hi_us == b.lo_us for a, b in zip(slices, slices[1:]))
        place = place_of(F.unix_micros("ts"), slices)
        held = dict(df.groupBy(place.alias("k")).count().collect())
        assert sorted(held) == list(range(n)) and sum(held.values()) == 30_000
        assert max(held.values()) <= 1.1 * 30_000 / n
        assert [df.where(between(df, "ts", s.lo_us, s.hi_us)).count() for s in slices[:3]] == [held[k] for k in range(n)][:3]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_weighted_slices_of_few_instants(spark):
    df = instants(spark, ["2024-01-01 00:00:00"] * 9 + ["2024-01-01 00:00:01"])
    slices = weighted_slices(df, find_range(df), "ts", 4)
    assert sum(df.where(between(df, "ts", s.lo_us, s.hi_us)).count() for s in slices) == 10
    assert weighted_slices(df, None, "ts", 4) == []
    one = instants(spark, ["2024-01-01 00:00:00"])
    assert len(weighted_slices(one, find_range(one), "ts", 4)) == 1
