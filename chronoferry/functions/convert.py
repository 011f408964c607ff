"""How a source type becomes a tag or a field.

The decision is made once per column from the schema, never per value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoferry.functions.timestamps import timestamp_text

TAG = "tag"
FLOAT_FIELD = "f64"
INT_FIELD = "i64"

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType)


def role_of(data_type: T.DataType, decimal: str = "long") -> str:
    """Whether a column is a tag, a floating field or an integer field."""
    if decimal not in ("long", "double"):
        raise ValueError(f"decimal must be 'long' or 'double', not {decimal!r}")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return FLOAT_FIELD
    if isinstance(data_type, _INT_TYPES):
        return INT_FIELD
    if isinstance(data_type, T.DecimalType):
        return INT_FIELD if decimal == "long" else FLOAT_FIELD
    return TAG


def converted(value: Column, data_type: T.DataType, decimal: str = "long", nested: str = "json") -> Column:
    """The value as double, bigint or tag text."""
    role = role_of(data_type, decimal)
    if role == FLOAT_FIELD:
        return value.cast("double")
    if role == INT_FIELD:
        # A decimal loses its fraction; one beyond 64 bits becomes NULL and the row stays.
        return value.try_cast("bigint") if isinstance(data_type, T.DecimalType) else value.cast("bigint")
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.BinaryType):
        return F.make_valid_utf8(value.cast("string"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_text(value)
    if isinstance(data_type, _NESTED_TYPES):
        if nested != "json":
            raise ValueError(f"nested type {data_type.simpleString()} has no tag form")
        return F.to_json(value)
    return value.cast("string")


def lost_in_conversion(value: Column, data_type: T.DataType, decimal: str = "long") -> Column | None:
    """True where a present value has no converted form; None if that cannot happen."""
    if isinstance(data_type, T.DecimalType) and decimal == "long" and data_type.precision - data_type.scale > 18:
        return value.isNotNull() & value.try_cast("bigint").isNull()
    return None
