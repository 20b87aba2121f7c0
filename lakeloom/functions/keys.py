"""Column expressions shared by merges, change capture and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_match(keys, left: str, right: str) -> Column:
    """Equality on every key column, AND-ed (NULL keys never match, as in SQL MERGE)."""
    return reduce(lambda a, b: a & b, [F.col(left + k) == F.col(right + k) for k in keys])


def changed(columns, left: str, right: str) -> Column:
    """True when any column differs, treating NULL = NULL as equal (IS DISTINCT FROM)."""
    if not columns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~F.col(left + c).eqNullSafe(F.col(right + c)) for c in columns])


def any_null(columns) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
