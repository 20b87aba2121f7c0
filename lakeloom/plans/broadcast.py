"""Size-checked broadcast.

A side is broadcast only after its rows and bytes were measured: one pass of
partial sums (each task sends one row on), strings by their actual length.
Where a commit recorded both, no pass is made. Beyond the bounds the caller
joins by a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class SizeCheck:
    rows: int
    bytes: int
    fits: bool


def _type_bytes(t: T.DataType) -> int:
    if isinstance(t, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    if isinstance(t, T.StructType):
        return sum(_type_bytes(f.dataType) for f in t.fields)
    return 16


def _measured(t: T.DataType) -> bool:
    """Whether values differ in size."""
    if isinstance(t, T.StructType):
        return any(_measured(f.dataType) for f in t.fields)
    return isinstance(t, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) or not isinstance(t, T.AtomicType)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values: fixed widths, and the actual length of strings
    and binaries (of nested values, of their JSON text)."""
    total = F.lit(8 + sum(_type_bytes(f.dataType) for f in schema.fields)).cast("long")
    for f in schema.fields:
        if _measured(f.dataType):
            flat = isinstance(f.dataType, (T.StringType, T.BinaryType))
            value = F.col(f"`{f.name}`") if flat else F.to_json(F.struct(F.col(f"`{f.name}`")))
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
    return total


def fits(rows: int, size: int, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    return rows <= max_rows and size <= max_bytes


def check_size(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> SizeCheck:
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df.schema))).first()
    return SizeCheck(n, size or 0, fits(n, size or 0, max_rows, max_bytes))


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES):
    """Return ``(frame, broadcast?)``: the frame hinted for broadcast only if it fits."""
    chk = check_size(df, max_rows, max_bytes)
    return (F.broadcast(df) if chk.fits else df), chk.fits
