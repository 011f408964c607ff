"""Cutting a range into equal-width time slices and naming the slice of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoferry.functions.columns import check_time_column, named, time_value
from chronoferry.functions.timestamps import epoch_us
from chronoferry.operators.ranges import TimeRange, in_range

SLICE_SCHEMA = "part_id bigint, lo_us bigint, hi_us bigint"


def time_slices(spark: SparkSession, rng: TimeRange | None, num_slices: int) -> DataFrame:
    """`part_id, lo_us, hi_us` for every slice.

    Inner edges lie on whole milliseconds, outer edges are those of the range. A
    range shorter than `num_slices` milliseconds leaves everything to the last slice.
    """
    if rng is None:
        return spark.createDataFrame([], SLICE_SCHEMA)
    slices = spark.range(num_slices, numPartitions=1).withColumnRenamed("id", "part_id")
    lo_us, hi_us = slice_edges(F.col("part_id"), rng, num_slices)
    return slices.select("part_id", lo_us.alias("lo_us"), hi_us.alias("hi_us"))


def slice_edges(part_id: Column, rng: TimeRange, num_slices: int) -> tuple[Column, Column]:
    """Start and exclusive end of a slice in microseconds, from its number."""
    origin, width = _grid(rng, num_slices)

    def inner(position: Column) -> Column:
        edge = _big(origin) + position * _big(width)
        return F.greatest(_big(rng.lo_us), F.least(edge, _big(rng.hi_us)))

    return (
        F.when(part_id == 0, _big(rng.lo_us)).otherwise(inner(part_id)),
        F.when(part_id == num_slices - 1, _big(rng.hi_us)).otherwise(inner(part_id + 1)),
    )


def slice_ranges(rng: TimeRange, num_slices: int) -> list[TimeRange]:
    """The same slices as numbers on the driver."""
    origin, width = _grid(rng, num_slices)
    inner = (max(rng.lo_us, min(origin + k * width, rng.hi_us)) for k in range(1, num_slices))
    edges = [rng.lo_us, *inner, rng.hi_us]
    return [TimeRange(lo, hi) for lo, hi in zip(edges, edges[1:])]


def slice_of(ts_us: Column, rng: TimeRange, num_slices: int) -> Column:
    """Number of the slice that holds an instant of the range: arithmetic, no join."""
    origin, width = _grid(rng, num_slices)
    last = _big(num_slices - 1)
    if width <= 0:
        return last
    return F.least(whole_div(ts_us - _big(origin), width), last)


def weighted_slices(df: DataFrame, rng: TimeRange | None, ts_col: str = "ts", num_slices: int = 8) -> list[TimeRange]:
    """At most `num_slices` slices of the range with similar row counts, without gap or overlap.

    Inner edges are quantiles of the time column, cut to whole milliseconds, from one narrow pass with a sketch
    that tasks merge; its rank error is a hundredth of a slice. A millisecond is never split: one with more rows
    than a slice stays whole.
    """
    if rng is None:
        return []
    shares = [k / num_slices for k in range(1, num_slices)]
    edges: list[int] = []
    if shares:
        us = epoch_us(time_value(df, ts_col))
        edge = F.percentile_approx(us, shares, 100 * num_slices)
        edges = in_range(df, rng, ts_col).agg(edge.alias("edges")).first()["edges"] or []
    inner = sorted({ms for us in edges if rng.lo_us < (ms := us // 1000 * 1000) < rng.hi_us})
    bounds = [rng.lo_us, *inner, rng.hi_us]
    return [TimeRange(lo, hi) for lo, hi in zip(bounds, bounds[1:])]


def place_of(ts_us: Column, slices: list[TimeRange]) -> Column:
    """Number of the slice that holds an instant, for any adjacent slices: a search tree of comparisons."""

    def search(first: int, last: int) -> Column:
        if first == last:
            return _big(first)
        middle = (first + last + 1) // 2
        below = ts_us < _big(slices[middle].lo_us)
        return F.when(below, search(first, middle - 1)).otherwise(search(middle, last))

    return search(0, len(slices) - 1)


def even_slices(counted: list[tuple[int, int, int]], num_slices: int) -> list[TimeRange]:
    """Neighbouring fine slices joined into about `num_slices` of similar row counts.

    `counted` holds `(lo_us, hi_us, rows)` of adjacent slices: bounded by how finely
    the range was cut and not by the rows. No stretch of time is left out.
    """
    share = max(1, -(-sum(rows for _, _, rows in counted) // num_slices))
    joined: list[TimeRange] = []
    held, lo = 0, None
    for slice_lo, slice_hi, rows in counted:
        if lo is not None and held and held + rows > share:
            joined.append(TimeRange(lo, slice_lo))
            held, lo = 0, None
        lo = slice_lo if lo is None else lo
        held += rows
        end = slice_hi
    if lo is not None:
        joined.append(TimeRange(lo, end))
    return joined


def with_slice(df: DataFrame, rng: TimeRange | None, ts_col: str = "ts", num_slices: int = 8) -> DataFrame:
    """Rows of the range with the `part_id` of their slice."""
    if "part_id" in df.columns:
        raise ValueError("the table already has a column named 'part_id'")
    rows = in_range(df, rng, ts_col)
    if rng is None:
        return rows.withColumn("part_id", F.lit(None).cast("bigint"))
    return rows.withColumn("part_id", slice_of(epoch_us(time_value(df, ts_col)), rng, num_slices))


def slice_counts(df: DataFrame, rng: TimeRange | None, ts_col: str = "ts", num_slices: int = 8) -> DataFrame:
    """Rows per slice that has any: counted before the shuffle, at most one row per slice and task."""
    check_time_column(df, ts_col)
    times = df.select(named(ts_col))
    return with_slice(times, rng, ts_col, num_slices).groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))


def _grid(rng: TimeRange, num_slices: int) -> tuple[int, int]:
    """Start and width of the inner grid in microseconds; the width truncates toward zero."""
    lo_ms, hi_ms = rng.lo_us // 1000, rng.hi_us // 1000
    span = hi_ms - lo_ms
    stride = abs(span) // num_slices * (1 if span >= 0 else -1)
    return lo_ms * 1000, stride * 1000


def whole_div(value: Column, divisor: int) -> Column:
    """Integer division of bigints; `/` would go through double."""
    return F.call_function("div", value, _big(divisor))


def _big(value: int) -> Column:
    return F.lit(value).cast("bigint")
