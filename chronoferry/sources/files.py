"""A table in files. Tasks follow the file splits; the time filter prunes row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoferry.functions.columns import project
from chronoferry.operators.ranges import TimeRange, in_range


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def scan(df: DataFrame, rng: TimeRange | None, ts_col: str = "ts", columns: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of the range, all columns or those named; filter and pruning reach the files."""
    return project(in_range(df, rng, ts_col), columns)
