"""Rows to points: string-like columns become tags, numbers become fields.

A point is one row with the columns `measurement`, `ts_ms`, `tags` and `fields`.
The last two are structs with one typed member per source column, in name order,
so a point stays a typed row: no map is built and nothing is boxed. `point_maps`
gives the map form for consumers that want it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.functions.columns import check_time_column, field_of, named, time_value
from chronoferry.functions.convert import FLOAT_FIELD, INT_FIELD, TAG, converted, lost_in_conversion, role_of
from chronoferry.functions.timestamps import epoch_ms

NULL_TIME = "time is null"
BAD_TIME = "time is not a timestamp"


@dataclass(frozen=True)
class PointLayout:
    """Which source columns are tags and which are fields, each in name order."""

    tags: tuple[str, ...]
    f64: tuple[str, ...]
    i64: tuple[str, ...]

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(sorted(self.f64 + self.i64))


def layout_of(df: DataFrame, ts_col: str = "ts", decimal: str = "long", ignore: tuple[str, ...] = ()) -> PointLayout:
    """Roles by schema; the time column is neither tag nor field."""
    check_time_column(df, ts_col)
    names = [f.name for f in df.schema.fields]
    if len(set(names)) != len(names):
        raise ValueError(f"column names repeat: {names}")
    by_role: dict[str, list[str]] = {TAG: [], FLOAT_FIELD: [], INT_FIELD: []}
    for f in df.schema.fields:
        if f.name != ts_col and f.name not in ignore:
            by_role[role_of(f.dataType, decimal)].append(f.name)
    return PointLayout(*(tuple(sorted(by_role[role])) for role in (TAG, FLOAT_FIELD, INT_FIELD)))


def layout_of_points(points: DataFrame) -> PointLayout:
    """The layout read back from the structs of a point table."""
    fields = points.schema["fields"].dataType.fields if "fields" in points.columns else []
    tags = points.schema["tags"].dataType.fields if "tags" in points.columns else []
    return PointLayout(
        tuple(sorted(f.name for f in tags)),
        tuple(sorted(f.name for f in fields if isinstance(f.dataType, T.DoubleType))),
        tuple(sorted(f.name for f in fields if isinstance(f.dataType, T.LongType))),
    )


def with_time(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Rows that can become points: the time is there and, if it is text, readable."""
    return df.where(time_value(df, ts_col).isNotNull())


def rejected_rows(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """The other rows, as `reason, row_json`. On a typed column this is a pushed `IS NULL`."""
    is_text = isinstance(check_time_column(df, ts_col), T.StringType)
    reason = F.lit(NULL_TIME)
    if is_text:
        reason = F.when(named(ts_col).isNull(), F.lit(NULL_TIME)).otherwise(F.lit(BAD_TIME))
    row = F.to_json(F.struct(*(named(c) for c in df.columns)), {"ignoreNullFields": "false"})
    return df.where(time_value(df, ts_col).isNull()).select(reason.alias("reason"), row.alias("row_json"))


def to_points(
    df: DataFrame,
    measurement: str,
    ts_col: str = "ts",
    decimal: str = "long",
    nested: str = "json",
    carry: tuple[str, ...] = (),
    ignore: tuple[str, ...] = (),
    beside: dict[str, Column] | None = None,
) -> DataFrame:
    """`measurement, ts_ms, tags, fields` for every row with a time; narrow, no shuffle.

    `carry` passes source columns through as a `seq` struct, for ordering in a
    later merge; `ignore` leaves columns out of tags and fields; `beside` has values of the row that are
    not part of the point, in a struct of that name, so that no column of the table is in their way.
    NULLs stay NULL members: they are absent from the point, and a row of NULLs is an empty point.
    """
    layout = layout_of(df, ts_col, decimal, ignore)
    types = {f.name: f.dataType for f in df.schema.fields}

    def members(names: tuple[str, ...]) -> Column:
        return F.struct(*(converted(named(c), types[c], decimal, nested).alias(c) for c in names))

    columns = [F.lit(measurement).alias("measurement"), epoch_ms(time_value(df, ts_col)).alias("ts_ms")]
    # A struct needs a member, so a table without tags or fields has no such column.
    if layout.tags:
        columns.append(members(layout.tags).alias("tags"))
    if layout.fields:
        columns.append(members(layout.fields).alias("fields"))
    if carry:
        columns.append(F.struct(*(named(c) for c in carry)).alias("seq"))
    if beside:
        columns.append(F.struct(*(value.alias(name) for name, value in beside.items())).alias("beside"))
    return with_time(df, ts_col).select(*columns)


def lost_values(df: DataFrame, decimal: str = "long", ignore: tuple[str, ...] = ()) -> Column:
    """How many present values of a row have no converted form and are left out of its point."""
    lost = F.lit(0)
    for f in df.schema.fields:
        if f.name not in ignore:
            test = lost_in_conversion(named(f.name), f.dataType, decimal)
            if test is not None:
                lost = lost + test.cast("int")
    return lost.cast("bigint")


def explode_points(points: DataFrame, **row_key: Column) -> DataFrame:
    """One row per present tag or field: `ts_ms, kind, key, s, f, i` after the named key columns.

    `s` holds tags, `f` floating fields, `i` integer fields; a point without
    values yields nothing.
    """
    layout = layout_of_points(points)
    no_s, no_f, no_i = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("bigint")

    def entry(kind: str, name: str, s: Column = no_s, f: Column = no_f, i: Column = no_i) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(name).alias("key"), s.alias("s"), f.alias("f"), i.alias("i")
        )

    entries = [entry(TAG, c, s=field_of("tags", c)) for c in layout.tags]
    entries += [entry(FLOAT_FIELD, c, f=field_of("fields", c)) for c in layout.f64]
    entries += [entry(INT_FIELD, c, i=field_of("fields", c)) for c in layout.i64]
    if not entries:
        raise ValueError("the points have neither tags nor fields")
    keys = [column.alias(name) for name, column in row_key.items()]
    return (
        points.select(*keys, "ts_ms", F.explode(F.array(*entries)).alias("entry"))
        .select(*row_key, "ts_ms", "entry.*")
        .where(F.col("s").isNotNull() | F.col("f").isNotNull() | F.col("i").isNotNull())
    )


def point_maps(points: DataFrame) -> DataFrame:
    """The map form: `measurement, tags, fields_f64, fields_i64, ts_ms` without NULL entries."""
    layout = layout_of_points(points)

    def as_map(struct: str, names: tuple[str, ...], value_type: str) -> Column:
        if not names:
            return F.create_map().cast(f"map<string,{value_type}>")
        pairs = [part for c in names for part in (F.lit(c), field_of(struct, c).cast(value_type))]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

    return points.select(
        "measurement",
        as_map("tags", layout.tags, "string").alias("tags"),
        as_map("fields", layout.f64, "double").alias("fields_f64"),
        as_map("fields", layout.i64, "bigint").alias("fields_i64"),
        "ts_ms",
    )


def field_count(points: DataFrame) -> Column:
    """Number of present fields of a point."""
    count = F.lit(0)
    for c in layout_of_points(points).fields:
        count = count + field_of("fields", c).isNotNull().cast("int")
    return count.cast("bigint")

