"""Point-in-time layer (extension; the original only declared it).

``scd2`` turns an ordered change log into validity intervals
(``valid_from``, ``valid_to``, ``is_current``); ``as_of`` picks each key's
last state at a time.

The "next row of the same key" is computed without putting a whole key into
one task. Rows are grouped by (key, sequence // bucket_width): a group holds
at most ``bucket_width`` rows because the sequence is unique per key, and a
hot key spreads over many groups, hashed across tasks. ``lead`` inside a
group is exact except for each group's last row; that row takes the first
row of the key's next non-empty group, found with a second, much smaller
window over one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.literals import lit_like
from lakeloom.operators.changes import latest_per_key

_BKT, _FIRST, _NF = "_h_bkt", "_h_first", "_h_next_first"

DEFAULT_BUCKET_WIDTH = 1 << 20


def next_in_key(df: DataFrame, keys, seq_col: str, value_cols, prefix: str = "next_", bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Add ``prefix + c`` (the following row's value within the key, by
    ``seq_col``) for each value column, and ``prefix + seq_col``.

    ``seq_col`` must be integral and unique per key.
    """
    keys = list(keys)
    value_cols = list(value_cols)
    tracked = [seq_col] + [c for c in value_cols if c != seq_col]
    # Exact integer floor division (no detour through double).
    w_ = int(bucket_width)
    seq = f"CAST(`{seq_col}` AS BIGINT)"
    src = df.withColumn(_BKT, F.expr(f"({seq} - pmod({seq}, {w_})) div {w_}"))
    w = Window.partitionBy(*keys, _BKT).orderBy(seq_col)
    d = src.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in tracked])

    # First row of each group, straight from the input: min / min_by keep a
    # fixed-width buffer for numeric and time columns, so this is a map-side
    # combined hash aggregate and only partial rows cross the shuffle.
    firsts = src.groupBy(*keys, _BKT).agg(
        F.struct(F.min(seq_col).alias(seq_col), *[F.min_by(c, seq_col).alias(c) for c in tracked[1:]]).alias(_FIRST)
    )
    wk = Window.partitionBy(*keys).orderBy(_BKT)
    nexts = firsts.select(*keys, _BKT, F.lead(_FIRST).over(wk).alias(_NF))

    # NULL keys are keys like any other.
    n = nexts.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.col(_BKT).alias("_n_bkt"), _NF)
    same = F.col(_BKT) == F.col("_n_bkt")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    j = d.join(n, same, "left")
    is_last = F.col(prefix + seq_col).isNull()
    out = [F.col(c) for c in df.columns] + [
        F.when(is_last, F.col(f"{_NF}.{c}")).otherwise(F.col(prefix + c)).alias(prefix + c) for c in tracked
    ]
    return j.select(*out)


def scd2(log: DataFrame, keys, seq_col: str, time_col: str, cols=None, bucket_width: int = DEFAULT_BUCKET_WIDTH, op_col: str | None = None, delete_op: str = "D") -> DataFrame:
    """Validity intervals: every log row is a version valid from its time until
    the next version's time; the last version per key is current. With
    ``op_col``, a delete ends its key's interval and is no version itself."""
    keys = list(keys)
    cols = list(cols) if cols is not None else [c for c in log.columns if c not in keys]
    nx = next_in_key(log, keys, seq_col, [time_col], prefix="_nx_", bucket_width=bucket_width)
    if op_col is not None:
        nx = nx.where(~F.col(op_col).eqNullSafe(F.lit(delete_op)))
    return nx.select(
        *keys,
        *[c for c in cols if c != time_col],
        F.col(time_col).alias("valid_from"),
        F.col("_nx_" + time_col).alias("valid_to"),
        F.col("_nx_" + seq_col).isNull().alias("is_current"),
    )


def as_of(log: DataFrame, keys, seq_col: str, time_col: str, ts, cols=None, op_col: str | None = None, delete_op: str = "D") -> DataFrame:
    """Each key's latest row with ``time_col <= ts`` (an aggregation, not a
    sort). With ``op_col``, keys deleted by then are left out."""
    keys = list(keys)
    cols = list(cols) if cols is not None else []
    upto = log.where(F.col(time_col) <= lit_like(ts, log, time_col))
    if op_col is None:
        return latest_per_key(upto, keys, seq_col, cols)
    latest = latest_per_key(upto, keys, seq_col, [*cols, *([op_col] if op_col not in cols else [])])
    latest = latest.where(~F.col(op_col).eqNullSafe(F.lit(delete_op)))
    return latest if op_col in cols else latest.drop(op_col)
