"""Type names used by config-declared schemas."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Generic type names accepted in table configs and the Spark
# type each one means. These must stay as listed for configs to mean the same
# thing as in the original loader: STRING, INT, LONG, FLOAT, DOUBLE, BOOLEAN,
# DATE, TIMESTAMP, and DECIMAL defaulting to precision 25, scale 3.
_NAMED_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL": T.DecimalType(25, 3),
}

# Extra names this library accepts beyond the fixed list.
_EXTRA_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "SHORT": T.ShortType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "TIMESTAMP_LTZ": T.TimestampType(),
}

_DECIMAL = re.compile(r"DECIMAL\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)")


def type_from_name(name: str | T.DataType) -> T.DataType:
    """Resolve a generic type name (``"LONG"``, ``"DECIMAL(10,2)"``) to a Spark type."""
    if isinstance(name, T.DataType):
        return name
    key = name.strip().upper()
    if key in _NAMED_TYPES:
        return _NAMED_TYPES[key]
    if key in _EXTRA_TYPES:
        return _EXTRA_TYPES[key]
    m = _DECIMAL.fullmatch(key)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unknown type name {name!r}")


def schema_from_columns(columns) -> T.StructType:
    """Build a StructType from ``[(name, type_name[, nullable]), ...]`` or a StructType."""
    if isinstance(columns, T.StructType):
        return columns
    fields = []
    for entry in columns:
        name, type_name, *rest = entry
        nullable = rest[0] if rest else True
        fields.append(T.StructField(name, type_from_name(type_name), nullable))
    return T.StructType(fields)
