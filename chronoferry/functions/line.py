"""Line protocol as column expressions: points to text, and text back to values.

    measurement[,tag=value...] field=value[,field=value...] epoch_ms

Names and tag values escape comma, equals sign and space; a measurement needs no
escape for the equals sign. Line breaks and tabs would end or split a line, so
they are written as backslash and letter, as which they stay. Integers end in `i`. Tags and fields
stand in name order, which is known from the schema, so nothing is sorted per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoferry.functions.columns import field_of
from chronoferry.operators.points import PointLayout, layout_of_points

# Fixed values of the text format.
ESCAPES = {",": "\\,", "=": "\\=", " ": "\\ ", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
MEASUREMENT_ESCAPES = {k: v for k, v in ESCAPES.items() if k != "="}

# Backslashes are plain characters unless they would swallow the separator after them,
# so a run of them is doubled in front of one and at the end of the text.
_BACKSLASH_RUN = r"(\\+)(?=[,= ]|(?![\s\S]))"


def escape_text(text: str) -> str:
    """Escape a name that is known when the plan is built."""
    text = re.sub(_BACKSLASH_RUN, r"\1\1", text)
    for plain, escaped in ESCAPES.items():
        text = text.replace(plain, escaped)
    return text


def escape_column(value: Column, escapes: dict[str, str] = ESCAPES) -> Column:
    """Escape text per row; plain replacements, with a pattern only where a backslash occurs."""
    doubled = F.regexp_replace(value, _BACKSLASH_RUN, "$1$1")
    safe = F.when(F.contains(value, F.lit("\\")), doubled).otherwise(value)
    for plain, escaped in escapes.items():
        safe = F.replace(safe, F.lit(plain), F.lit(escaped))
    return safe


def is_writable(points: DataFrame) -> Column:
    """True for points with at least one field that has a text form."""
    layout = layout_of_points(points)
    test = F.lit(False)
    for c in layout.i64:
        test |= field_of("fields", c).isNotNull()
    for c in layout.f64:
        test |= F.coalesce(_is_finite(field_of("fields", c)), F.lit(False))
    return test


def line_of(points: DataFrame) -> Column:
    """The line of a point with a writable field."""
    layout = layout_of_points(points)
    identity = [escape_column(F.col("measurement"), MEASUREMENT_ESCAPES), *(_tag(c) for c in layout.tags)]
    fields = [_field(c, layout) for c in layout.fields]
    return F.concat_ws(
        " ", F.concat_ws(",", *identity), F.concat_ws(",", *fields), F.col("ts_ms").cast("string")
    )


def to_lines(points: DataFrame) -> DataFrame:
    """One column `line`; points without a writable field are left out."""
    return points.where(is_writable(points)).select(line_of(points).alias("line"))


def parse_lines(lines: DataFrame, layout: PointLayout) -> DataFrame:
    """Points back from lines, for checking what was written. Absent members are NULL."""
    part = F.split("line", " ", 3)
    cut = lines.select(_mark_escaped(F.col("line")).alias("line")).select(
        F.split(part[0], ",").alias("identity"), F.split(part[1], ",").alias("pairs"), part[2].alias("ts_ms")
    )

    def as_map(pairs: Column) -> Column:
        return F.map_from_entries(
            F.transform(
                pairs,
                lambda x: F.struct(
                    _unmark(F.substring_index(x, "=", 1)).alias("k"), F.substring_index(x, "=", -1).alias("v")
                ),
            )
        )

    tags = F.slice("identity", F.lit(2), F.size("identity"))
    read = cut.select(
        _unmark(F.col("identity")[0]).alias("measurement"),
        F.col("ts_ms").cast("bigint"),
        as_map(tags).alias("tag_map"),
        as_map(F.col("pairs")).alias("field_map"),
    )
    columns = ["measurement", "ts_ms"]
    if layout.tags:
        columns.append(F.struct(*(_unmark(F.col("tag_map")[c]).alias(c) for c in layout.tags)).alias("tags"))
    if layout.fields:
        columns.append(F.struct(*(_read_field(c, layout).alias(c) for c in layout.fields)).alias("fields"))
    return read.select(*columns)


def _tag(name: str) -> Column:
    value = field_of("tags", name)
    # An empty tag value cannot be written and means the same as no tag.
    return F.when(value != "", F.concat(F.lit(escape_text(name) + "="), escape_column(value)))


def _field(name: str, layout: PointLayout) -> Column:
    value = field_of("fields", name)
    key = F.lit(escape_text(name) + "=")
    if name in layout.i64:
        return F.concat(key, value.cast("string"), F.lit("i"))
    return F.when(_is_finite(value), F.concat(key, value.cast("string")))


def _is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != float("inf"))


def _read_field(name: str, layout: PointLayout) -> Column:
    value = F.col("field_map")[name]
    return F.rtrim(value, F.lit("i")).cast("bigint") if name in layout.i64 else value.cast("double")


# Stand-ins for escaped separators while a line is split; the first frees the mark itself.
_MARKS = {"\x01": "\x010", ",": "\x01c", "=": "\x01e", " ": "\x01s"}


def _mark_escaped(line: Column) -> Column:
    """Replace escaped separators, so that those left are real. An odd run of backslashes escapes."""
    line = F.replace(line, F.lit("\x01"), F.lit(_MARKS["\x01"]))
    marked = line
    for plain in ",= ":
        marked = F.regexp_replace(marked, rf"(?<!\\)((?:\\\\)*+)\\{plain}", "$1" + _MARKS[plain])
    return F.when(F.contains(line, F.lit("\\")), marked).otherwise(line)


def _unmark(text: Column) -> Column:
    """A name or value as it was before escaping."""
    halved = F.regexp_replace(text, r"(?<!\\)(\\+)\1(?=\x01[ces]|(?![\s\S]))", "$1")
    text = F.when(F.contains(text, F.lit("\\")), halved).otherwise(text)
    for plain in (",", "=", " ", "\x01"):
        text = F.replace(text, F.lit(_MARKS[plain]), F.lit(plain))
    return text
