"""Points with equal identity become one, as the target store would make them.

Identity is measurement, tag set and millisecond. Fields merge one by one: the
present value that comes last in `seq` order wins. This is what makes a repeated
copy harmless, and doing it before the write shows how many rows it costs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.functions.columns import field_of
from chronoferry.functions.timestamps import epoch_us
from chronoferry.operators.points import PointLayout, layout_of_points

# The largest order values that Spark aggregates in place.
_LONG, _DECIMAL = 2**63 - 1, 10**38 - 1
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Packing:
    """How several order columns become one number: least value and number of values of each, NULL included."""

    columns: tuple[str, ...]
    least: tuple[int, ...]
    sizes: tuple[int, ...]

    @property
    def largest(self) -> int:
        product = 1
        for size in self.sizes:
            product *= size
        return product - 1


def merge_points(points: DataFrame, packing: Packing | None = None) -> DataFrame:
    """Merge points that carry a `seq` struct (see `to_points`); `seq` must be unique within a point.

    One shuffle on the identity. Each task merges its own rows first, so one identity that holds much of
    the table leaves a row per task. Whole numbers and times as order columns are packed into one number
    (see `find_packing`, which runs a job over them if no packing is given), so that tasks merge in a hash
    table; what can't be packed is compared as a struct, which Spark sorts for. Numbers `beside` the points
    are added up in a struct of that name.
    """
    layout = _ordered_layout(points)
    if packing is None:
        packing = find_packing(points)
    order = field_of("seq", points.schema["seq"].dataType.fieldNames()[0]) if _is_single(points) else F.col("seq")
    if packing is not None:
        order = _packed(points, packing)
    flat, keys = flat_points(points, layout, order)
    # Time comes first because sorts compare the first key by its prefix alone; the measurement
    # is mostly one and the same.
    merged = flat.groupBy("ts_ms", *keys, "measurement").agg(*merging(points, layout))
    return merged_columns(merged, points, layout)


def find_packing(points: DataFrame) -> Packing | None:
    """The packing of the `seq` columns, from their least and greatest values; reads only these columns.

    None if there is one column alone, if one is neither a whole number nor a time, or if the product of
    their ranges is beyond 38 digits.
    """
    if _is_single(points):
        return None
    names = points.schema["seq"].dataType.fieldNames()
    numbers = {name: _as_whole(points, name) for name in names}
    if any(number is None for number in numbers.values()):
        return None
    extremes = [f(numbers[n]).alias(f"{kind}_{k}") for k, n in enumerate(names) for kind, f in (("lo", F.min), ("hi", F.max))]
    row = points.agg(*extremes).first()
    bounds = [(row[f"lo_{k}"] or 0, row[f"hi_{k}"] or 0) for k in range(len(names))]
    packing = Packing(tuple(names), tuple(lo for lo, _ in bounds), tuple(hi - lo + 2 for lo, hi in bounds))
    return packing if packing.largest <= _DECIMAL else None


def flat_points(points: DataFrame, layout: PointLayout, order: Column) -> tuple[DataFrame, list[str]]:
    """Points with a plain column for each member, under names of this module, and the names of the tags."""
    tags = [field_of("tags", c) for c in layout.tags]
    fields = [field_of("fields", c) for c in layout.fields]
    others = [c for c in ("beside",) if c in points.columns]
    flat = points.select(
        "measurement",
        "ts_ms",
        # An absent tag and an empty one are the same identity.
        *(F.nullif(tag, F.lit("")).alias(f"tag_{i}") for i, tag in enumerate(tags)),
        *(field.alias(f"field_{i}") for i, field in enumerate(fields)),
        order.alias("seq"),
        *others,
    )
    return flat, [f"tag_{i}" for i in range(len(tags))]


def merging(points: DataFrame, layout: PointLayout) -> list[Column]:
    """The aggregates over `flat_points`."""
    sums = points.schema["beside"].dataType.fieldNames() if "beside" in points.columns else []
    return [
        *(_last_present(f"field_{i}").alias(f"field_{i}") for i in range(len(layout.fields))),
        F.count(F.lit(1)).alias("merged_rows"),
        *(F.sum(field_of("beside", c)).alias(f"sum_{i}") for i, c in enumerate(sums)),
    ]


def merged_columns(merged: DataFrame, points: DataFrame, layout: PointLayout) -> DataFrame:
    """The aggregated columns as those of points again."""
    columns = ["measurement", "ts_ms"]
    for struct, short, names in (("tags", "tag", layout.tags), ("fields", "field", layout.fields)):
        if names:
            columns.append(F.struct(*(F.col(f"{short}_{i}").alias(c) for i, c in enumerate(names))).alias(struct))
    if "beside" in points.columns:
        sums = points.schema["beside"].dataType.fieldNames()
        columns.append(F.struct(*(F.col(f"sum_{i}").alias(c) for i, c in enumerate(sums))).alias("beside"))
    return merged.select(*columns, "merged_rows")


def _ordered_layout(points: DataFrame) -> PointLayout:
    if "seq" not in points.columns:
        raise ValueError("merging needs an order: build the points with carry=(columns, ...)")
    return layout_of_points(points)


def _is_single(points: DataFrame) -> bool:
    return len(points.schema["seq"].dataType.fields) == 1


def _last_present(name: str) -> Column:
    # max_by ignores rows whose ordering value is NULL.
    return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col("seq")))


def _as_whole(points: DataFrame, name: str) -> Column | None:
    kind, value = points.schema["seq"].dataType[name].dataType, field_of("seq", name)
    if isinstance(kind, _WHOLE):
        return value.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    return epoch_us(value) if isinstance(kind, _TIMES) else None


def _packed(points: DataFrame, packing: Packing) -> Column:
    """The columns as digits of one number; a NULL is the least digit, as it is the least member of a struct."""
    kind = "bigint" if packing.largest <= _LONG else "decimal(38,0)"

    def fixed(number: int) -> Column:
        return F.lit(str(number)).cast(kind)

    number = fixed(0)
    for name, least, size in zip(packing.columns, packing.least, packing.sizes):
        digit = F.coalesce(_as_whole(points, name).cast(kind) - fixed(least - 1), fixed(0))
        number = (number * fixed(size) + digit).cast(kind)
    return number
