"""Finding the time range of a table.

A range is half open, in epoch microseconds. A given end is exclusive; an end
found in the data is made one microsecond larger than the newest row, so that
row is moved too. `compat=True` keeps the found end exclusive and cuts both
bounds to milliseconds, for comparing with jobs that behave so.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.functions.columns import check_time_column, time_value
from chronoferry.functions.timestamps import epoch_us, instant

log = logging.getLogger(__name__)

RANGE_SCHEMA = "lo_us bigint, hi_us bigint"


@dataclass(frozen=True)
class TimeRange:
    lo_us: int
    hi_us: int


def parse_bounds(
    spark: SparkSession, start: str | None, end: str | None, lenient: bool = False
) -> tuple[int | None, int | None]:
    """Text bounds as microseconds in the session zone; None for absent ones.

    Anything that Spark reads as a timestamp is a bound, a bare date among it. A bound that is given but
    can't be read is an error, or with `lenient` a warning and absent: dropping it would copy more than asked.
    The query has no table behind it and is folded on the driver, so no job runs.
    """
    start, end = (b if b and b.strip() else None for b in (start, end))
    row = spark.sql(
        "SELECT CAST(:start AS STRING) AS start, CAST(:end AS STRING) AS end",
        args={"start": start, "end": end},
    ).select(*(epoch_us(F.trim(c).try_cast("timestamp")).alias(c) for c in ("start", "end"))).first()
    for name, text in (("start", start), ("end", end)):
        if text is not None and row[name] is None:
            if not lenient:
                raise ValueError(f"the {name} of the range can't be read as a time: {text!r}")
            log.warning("the %s of the range can't be read as a time and is left out: %r", name, text)
    return row["start"], row["end"]


def range_frame(
    df: DataFrame,
    ts_col: str = "ts",
    start: str | None = None,
    end: str | None = None,
    compat: bool = False,
    lenient: bool = False,
) -> DataFrame:
    """One row `lo_us, hi_us`, or no row when nothing lies between the bounds.

    Two readable bounds are echoed without looking at the data. Otherwise one
    pass over the time column alone finds the smallest and largest value between
    whichever bounds are given. `lenient` is as in `parse_bounds`.
    """
    spark = df.sparkSession
    start_us, end_us = parse_bounds(spark, start, end, lenient)
    if start_us is not None and end_us is not None:
        found = spark.sql("SELECT :lo AS lo_us, :hi AS hi_us", args={"lo": start_us, "hi": end_us})
        found = found.select(F.col("lo_us").cast("bigint"), F.col("hi_us").cast("bigint"))
    else:
        ts = time_value(df, ts_col)
        extremes = df.where(between(df, ts_col, start_us, end_us)).agg(
            F.min(ts).alias("oldest"), F.max(ts).alias("newest")
        )
        last = epoch_us(F.col("newest"))
        found = extremes.select(
            F.greatest(epoch_us(F.col("oldest")), *_bound(start_us)).alias("lo_us"),
            F.least(last if compat else last + F.lit(1), *_bound(end_us)).alias("hi_us"),
        ).where(last.isNotNull())
    if compat:
        found = found.select(*(_floor_ms(F.col(c)).alias(c) for c in ("lo_us", "hi_us")))
    return found


def find_range(
    df: DataFrame,
    ts_col: str = "ts",
    start: str | None = None,
    end: str | None = None,
    compat: bool = False,
    lenient: bool = False,
) -> TimeRange | None:
    """The range as two numbers on the driver, None when it is empty."""
    row = range_frame(df, ts_col, start, end, compat, lenient).first()
    return None if row is None else TimeRange(row["lo_us"], row["hi_us"])


def between(df: DataFrame, ts_col: str, lo_us: int | None, hi_us: int | None) -> Column:
    """Half-open filter on the raw time column, so it is pushed into the scan."""
    data_type = check_time_column(df, ts_col)
    ts = time_value(df, ts_col)
    condition = ts.isNotNull()
    if lo_us is not None:
        condition &= ts >= instant(lo_us, data_type)
    if hi_us is not None:
        condition &= ts < instant(hi_us, data_type)
    return condition


def in_range(df: DataFrame, rng: TimeRange | None, ts_col: str = "ts") -> DataFrame:
    """Rows inside the range; none at all for an empty range."""
    if rng is None:
        check_time_column(df, ts_col)
        return df.where(F.lit(False))
    return df.where(between(df, ts_col, rng.lo_us, rng.hi_us))


def _bound(us: int | None) -> tuple[Column, ...]:
    # greatest/least need two arguments and skip NULLs, so an absent bound is a NULL.
    return (F.lit(us).cast(T.LongType()),)


def _floor_ms(us: Column) -> Column:
    return us - F.pmod(us, F.lit(1000))
