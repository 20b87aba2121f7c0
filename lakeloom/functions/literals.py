"""Literals typed like the column they are compared with."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_lit(value, data_type: T.DataType) -> Column:
    """A literal of ``data_type``.

    Datetimes go through ISO text, so a wall-clock value means the same for a
    ``timestamp_ntz`` column whatever the session or OS time zone is (a Python
    datetime literal would pass through a session-zone instant first).
    """
    if isinstance(value, (dt.datetime, dt.date)):
        return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()).cast(data_type)
    return F.lit(value).cast(data_type)


def lit_like(value, df, col: str) -> Column:
    """A literal cast to the type of ``df[col]``."""
    return typed_lit(value, df.schema[col].dataType)
