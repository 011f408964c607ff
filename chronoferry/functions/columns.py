"""Resolving columns by their exact names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.functions.timestamps import parse_timestamp

_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType)


def named(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def field_of(struct: str, name: str) -> Column:
    """A member of a struct column by its literal name."""
    return F.col(struct).getField(name)


def project(rows: DataFrame, columns: tuple[str, ...] | None) -> DataFrame:
    """The columns of these literal names, or all."""
    return rows.select(*(named(c) for c in columns)) if columns else rows


def check_time_column(df: DataFrame, ts_col: str) -> T.DataType:
    """Type of the time column; its name must match exactly, letter case included."""
    if ts_col not in df.columns:
        raise ValueError(f"no time column named exactly {ts_col!r} in {df.columns}")
    data_type = df.schema[ts_col].dataType
    if not isinstance(data_type, _TIME_TYPES):
        raise ValueError(f"time column {ts_col!r} has type {data_type.simpleString()}")
    return data_type


def time_value(df: DataFrame, ts_col: str) -> Column:
    """The time of a row; the raw column whenever possible so that filters reach the scan."""
    if isinstance(check_time_column(df, ts_col), T.StringType):
        return parse_timestamp(named(ts_col))
    return named(ts_col)
