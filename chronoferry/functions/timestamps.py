"""Time conversions as column expressions.

Epoch values floor toward the past, so an instant just before 1970 maps to -1.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: date and time are both required, up to nine fraction digits.
TIMESTAMP_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,9})?\s*$"


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def instant(us: int, data_type: T.DataType | None = None) -> Column:
    """A microsecond instant as a literal of the compared column's type.

    The value folds to a constant, which keeps comparisons with a raw column pushable.
    """
    value = F.timestamp_micros(F.lit(us).cast("bigint"))
    if isinstance(data_type, T.TimestampNTZType):
        return value.cast("timestamp_ntz")
    return value


def parse_timestamp(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss[.fraction]` to a timestamp, NULL for anything else."""
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp"))


def timestamp_text(ts: Column) -> Column:
    """Timestamp text that always carries at least one fraction digit."""
    text = ts.cast("string")
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def instant_text(us: int) -> str:
    """The same text, in UTC, for a number on the driver."""
    moment = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)
    fraction = f"{moment.microsecond:06d}".rstrip("0") or "0"
    return f"{moment:%Y-%m-%d %H:%M:%S}.{fraction}"
