"""Reconciliation and constraint checks (primary key, not-null, foreign key).

Each check returns a DataFrame of violations or a one-row summary; the
``require_*`` helpers raise with a few sample keys for use before a merge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.keys import any_null
from lakeloom.plans.broadcast import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, maybe_broadcast


class CheckFailed(Exception):
    pass


@dataclass(frozen=True)
class CountCheck:
    expected: int
    actual: int

    @property
    def ok(self) -> bool:
        return self.expected == self.actual

    def to_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(self.expected, self.actual, self.ok)], "expected long, actual long, ok boolean"
        )


def count_check(expected: int, actual: int) -> CountCheck:
    return CountCheck(int(expected), int(actual))


def duplicate_keys(df: DataFrame, keys, count_col: str = "n") -> DataFrame:
    """Key values that occur more than once, with their counts.

    Partial aggregation counts each key inside every task first, so a hot key
    arrives at the shuffle as one row per task."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def null_counts(df: DataFrame, columns, null_values: dict | None = None) -> DataFrame:
    """One row, one ``<col>_nulls`` count per column, in one pass.

    ``null_values`` maps a column to a value that also counts as missing
    (e.g. a sentinel such as 'P' or an empty string)."""
    null_values = null_values or {}
    aggs = []
    for c in columns:
        cond = F.col(c).isNull()
        if c in null_values:
            cond = cond | (F.col(c) == F.lit(null_values[c]))
        aggs.append(F.count(F.when(cond, 1)).alias(f"{c}_nulls"))
    return df.agg(*aggs)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    fk_cols,
    parent_cols=None,
    max_broadcast_rows: int = DEFAULT_MAX_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Child rows whose foreign key has no parent (rows with a NULL key are
    not orphans, as in SQL foreign keys). Only key columns are read.

    * Parent keys proven small (bounded count): one broadcast anti join; the
      child is scanned once and never shuffled.
    * Otherwise the child is first reduced to its distinct key values
      (combined map-side, so a hot key costs one row per task), those are
      anti-joined with the parent, and the child is semi-joined with the
      orphan values, broadcast when they are proven small. No child row moves
      through a shuffle keyed by a single hot value.
    """
    fk_cols = list(fk_cols)
    parent_cols = list(parent_cols or fk_cols)
    # Parent columns are a key, so no distinct (and no extra shuffle) is needed.
    pkeys = parent.select(*[F.col(p).alias(f) for p, f in zip(parent_cols, fk_cols)])
    live = child
    for c in fk_cols:
        live = live.where(F.col(c).isNotNull())
    small_parent, fits = maybe_broadcast(pkeys, max_broadcast_rows, max_broadcast_bytes)
    if fits:
        return live.join(small_parent, fk_cols, "left_anti")
    missing = live.select(*fk_cols).distinct().join(pkeys, fk_cols, "left_anti")
    missing, _ = maybe_broadcast(missing, max_broadcast_rows, max_broadcast_bytes)
    return live.join(missing, fk_cols, "left_semi")


def require_keys_valid(df: DataFrame, keys, what: str = "batch", sample: int = 5) -> None:
    """NULL keys and duplicate keys in one aggregation (NULL keys group together)."""
    keys = list(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bad = counted.where((F.col("n") > 1) | any_null(keys)).limit(sample).collect()
    if bad:
        raise CheckFailed(f"{what}: NULL or duplicate keys, e.g. {[tuple(r) for r in bad]}")
