"""How many rows each slice holds, and the milestones a copy passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoferry.config import DEFAULT_BATCH_SIZE, MILESTONE_BATCHES
from chronoferry.operators.ranges import TimeRange
from chronoferry.operators.slices import slice_counts, time_slices, whole_div

# Milestones are generated in blocks of this many, so no array grows with the data.
_BLOCK = 1000


def slice_totals(df: DataFrame, rng: TimeRange | None, ts_col: str = "ts", num_slices: int = 8) -> DataFrame:
    """`part_id, lo_us, hi_us, total` for every slice, empty ones included."""
    counts = slice_counts(df, rng, ts_col, num_slices)
    slices = time_slices(df.sparkSession, rng, num_slices)
    # Both sides have one row per slice; Spark picks the join.
    return slices.join(counts, "part_id", "left").select(
        "part_id", "lo_us", "hi_us", F.coalesce("n", F.lit(0).cast("bigint")).alias("total")
    )


def milestones(totals: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """`part_id, processed`: every tenth full batch that a slice reaches."""
    step = batch_size * MILESTONE_BATCHES
    reached = whole_div(F.col("total"), step)
    return (
        totals.select("part_id", reached.alias("reached"))
        .where(F.col("reached") > 0)
        .withColumn("first", F.explode(F.sequence(_one(), F.col("reached"), F.lit(_BLOCK).cast("bigint"))))
        .withColumn("last", F.least(F.col("first") + (_BLOCK - 1), F.col("reached")))
        .withColumn("ordinal", F.explode(F.sequence(F.col("first"), F.col("last"), _one())))
        .select("part_id", (F.col("ordinal") * step).alias("processed"))
    )


def slice_sizes(df: DataFrame, rng: TimeRange, ts_col: str = "ts", num_slices: int = 8) -> dict[int, int]:
    """The rows of every slice, empty ones included: `num_slices` numbers, whatever the size of the table.

    One narrow pass over the time column. Counts per task are summed after a shuffle, as any query result, so
    a task that runs again or twice changes nothing.
    """
    counted = slice_counts(df, rng, ts_col, num_slices).collect()
    return dict.fromkeys(range(num_slices), 0) | {row["part_id"]: row["n"] for row in counted}


def _one() -> Column:
    return F.lit(1).cast("bigint")
