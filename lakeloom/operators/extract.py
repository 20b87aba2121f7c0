"""Extraction population: high-water mark and full / incremental predicates.

The predicates are ordinary DataFrame filters, so Catalyst pushes them into
the JDBC query or the parquet scan; no SQL text is assembled here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.literals import lit_like
from lakeloom.spec import TableSpec

TIMESTAMP_FLOOR = dt.datetime(1900, 1, 1)


def _lit_like(value, df: DataFrame, col: str) -> Column:
    """A literal cast to the column's own type (keeps NTZ / LTZ / integer semantics)."""
    return lit_like(value, df, col)


def high_water_mark(df: DataFrame, col: str, floor=TIMESTAMP_FLOOR, alias: str = "max_time_stamp") -> DataFrame:
    """One-row frame: ``coalesce(max(col), floor)``. A global aggregate with partial
    (map-side) aggregation; only one value per task crosses the shuffle."""
    return df.agg(F.coalesce(F.max(col), _lit_like(floor, df, col)).alias(alias))


def high_water_mark_seq(df: DataFrame, col: str, floor: int = 0, alias: str = "max_seq") -> DataFrame:
    """Sequence-keyed variant (integer update column, integer floor)."""
    return high_water_mark(df, col, floor, alias)


def extract_full(df: DataFrame, update_col: str | None = None, run_ts=None) -> DataFrame:
    """Full population, bounded by the run time when an update column exists."""
    if update_col is None or run_ts is None:
        return df
    return df.where(F.col(update_col) <= _lit_like(run_ts, df, update_col))


def lower_bound(hwm, overlap):
    """``hwm - overlap``; works for timestamps (timedelta) and sequences (int)."""
    return hwm - overlap


def extract_incremental(df: DataFrame, update_col: str, hwm, run_ts, overlap=dt.timedelta(days=1)) -> DataFrame:
    """Rows with ``update_col BETWEEN hwm - overlap AND run_ts`` (both ends inclusive).

    The overlap re-reads a margin below the mark so late-committed source rows
    are not missed; re-reading is harmless because the merge is idempotent.
    """
    lo = _lit_like(lower_bound(hwm, overlap), df, update_col)
    if run_ts is None:
        return df.where(F.col(update_col) >= lo)
    hi = _lit_like(run_ts, df, update_col)
    return df.where(F.col(update_col).between(lo, hi))


def extract(df: DataFrame, spec: TableSpec, hwm, run_ts) -> DataFrame:
    """Dispatch on the spec's load mode. A run time does not bound a sequence."""
    if spec.sequence_watermark and isinstance(run_ts, dt.datetime):
        run_ts = None
    if spec.is_full:
        return extract_full(df, spec.update_col, run_ts)
    if spec.update_col is None:
        raise ValueError(f"{spec.name}: incremental load needs an update column")
    return extract_incremental(df, spec.update_col, hwm, run_ts, spec.overlap)
