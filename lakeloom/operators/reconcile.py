"""Content reconciliation: do two tables hold the same rows, and if not, where?

A row's digest is two 64-bit hashes of all its columns; digests are summed, so
the sum of a key range does not depend on the order of its rows, and sums of
ranges add up to those of larger ranges. Leaf ranges of the key are summed in
one pass per side (combined map-side, one row per range and task) and rolled
up to a tree. The trees are compared from the root: only children of ranges
that differ are looked at, and only the rows of leaf ranges that differ are
read again and compared one by one.

Hash sums of different contents are equal by chance only: about 2**-64 per
comparison of unrelated rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.changes import change_log
from lakeloom.plans.broadcast import maybe_broadcast
from lakeloom.plans.workspace import checkpoint_dir

NODE, ROWS = "node", "rows"
_SUMS = ("d0", "d1", "d2", "d3")
#: So many ranges are read back by a filter that the scan can use; more by a join.
FILTER_RANGES = 200


def _halves(df: DataFrame) -> list[Column]:
    """Four halves of two row hashes; sums of 2**31 of them do not overflow a long."""
    columns = sorted(df.columns)
    out = []
    for seed in (0, 1):
        # NULLs are skipped by the hash, so each value is told apart by whether it is there.
        h = F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
        out += [F.shiftrightunsigned(h, 32), h.bitwiseAND(0xFFFFFFFF)]
    return out


def _leaf(key: str, width: int) -> Column:
    k = f"CAST(`{key}` AS BIGINT)"
    return F.expr(f"({k} - pmod({k}, {int(width)}L)) div {int(width)}L")


def range_digests(df: DataFrame, key: str, width: int) -> DataFrame:
    """``node, rows, d0..d3``: leaf ranges ``[node * width, (node + 1) * width)`` of the
    integral ``key`` that have rows; rows without key form the node NULL."""
    leaf = df.select(_leaf(key, width).alias(NODE), *[h.alias(d) for h, d in zip(_halves(df), _SUMS)])
    sums = [F.sum(F.col(d).cast("decimal(38,0)")).alias(d) for d in _SUMS]
    return leaf.groupBy(NODE).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of one level whose sums differ, or that only one side has."""
    x = a.select(F.col(NODE).alias("a_node"), F.col(ROWS).alias("a_rows"), *[F.col(d).alias("a_" + d) for d in _SUMS])
    y = b.select(F.col(NODE).alias("b_node"), F.col(ROWS).alias("b_rows"), *[F.col(d).alias("b_" + d) for d in _SUMS])
    j = x.join(y, F.col("a_node").eqNullSafe(F.col("b_node")), "full_outer")
    same = reduce(lambda p, q: p & q, [F.col("a_" + c).eqNullSafe(F.col("b_" + c)) for c in (ROWS, *_SUMS)])
    return j.where(~same).select(
        F.coalesce("a_node", "b_node").alias(NODE), F.coalesce("a_rows", F.lit(0)).alias("rows_before"), F.coalesce("b_rows", F.lit(0)).alias("rows_after")
    )


def differing_leaves(before: DataFrame, after: DataFrame, fanout: int = 16) -> DataFrame:
    """``node, rows_before, rows_after`` of the leaf ranges that differ, found
    from the root of both trees (whose leaves are stored: they are read once a level)."""
    bounds = before.select(NODE).unionByName(after.select(NODE))
    # Both trees get the height of the taller one.
    lo, hi = bounds.agg(F.min(NODE), F.max(NODE)).first()
    height = 0
    while lo is not None and hi - lo >= fanout:
        lo, hi, height = lo // fanout, hi // fanout, height + 1
    trees = [_levels(side, fanout, height) for side in (before, after)]
    found = None
    for level in range(height, -1, -1):
        a, b = trees[0][level], trees[1][level]
        if found is not None:
            parents, _ = maybe_broadcast(found.select(F.col(NODE).alias("_parent")))
            a, b = (x.join(parents, _leaf(NODE, fanout).eqNullSafe(F.col("_parent")), "left_semi") for x in (a, b))
        found = _differ(a, b)
    return found


def _levels(leaves: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    levels = [leaves]
    for _ in range(height):
        up = levels[-1].withColumn(NODE, _leaf(NODE, fanout)).groupBy(NODE)
        up = up.agg(F.sum(ROWS).alias(ROWS), *[F.sum(d).cast("decimal(38,0)").alias(d) for d in _SUMS])
        levels.append(up)
    return levels


def reconcile_ranges(before: DataFrame, after: DataFrame, key: str, width: int, fanout: int = 16, digests: tuple[DataFrame | None, DataFrame | None] = (None, None)) -> DataFrame:
    """``lower, upper, rows_before, rows_after``: the key ranges ``[lower, upper)`` whose rows differ
    (``lower, upper`` NULL: rows without key). ``digests`` are the stored
    :func:`range_digests` of a side, if it has them: then that side is not read."""
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the two sides have different columns")
    leaves = [d if d is not None else range_digests(df.select(*sorted(df.columns)), key, width) for df, d in zip((before, after), digests)]
    checkpoint_dir(before.sparkSession)
    found = differing_leaves(*[x.checkpoint() if d is None else x for x, d in zip(leaves, digests)], fanout)
    return found.select((F.col(NODE) * width).alias("lower"), ((F.col(NODE) + 1) * width).alias("upper"), "rows_before", "rows_after")


def rows_in_ranges(df: DataFrame, key: str, ranges: DataFrame, width: int) -> DataFrame:
    """The rows of ``df`` in the given ranges. A few, merged where they touch,
    become a filter that reaches the scan; many are joined by leaf."""
    few = ranges.select("lower").limit(FILTER_RANGES + 1).collect()
    if len(few) <= FILTER_RANGES:
        starts = sorted(r["lower"] for r in few if r["lower"] is not None)
        merged: list[list[int]] = []
        for s in starts:
            if merged and merged[-1][1] == s:
                merged[-1][1] = s + width
            else:
                merged.append([s, s + width])
        wanted = [(F.col(key) >= lo) & (F.col(key) < hi) for lo, hi in merged]
        wanted += [F.col(key).isNull()] if len(starts) < len(few) else []
        return df.where(reduce(lambda a, b: a | b, wanted)) if wanted else df.where(F.lit(False))
    leaves, _ = maybe_broadcast(ranges.select(F.expr(f"lower div {int(width)}L").alias("_leaf")))
    return df.join(leaves, _leaf(key, width).eqNullSafe(F.col("_leaf")), "left_semi")


def range_key(before: DataFrame, after: DataFrame, keys, ranges: int) -> tuple[str, int, tuple[DataFrame, DataFrame]]:
    """A column to compare by, the width of about ``ranges`` leaf ranges, and both
    sides with it: the key itself if it is one integral column, else a hash of the keys."""
    keys = list(keys)
    if len(keys) == 1 and isinstance(after.schema[keys[0]].dataType, T.IntegralType):
        bounds = [df.agg(F.min(keys[0]), F.max(keys[0])).first() for df in (before, after)]
        known = [int(v) for b in bounds for v in b if v is not None]
        return keys[0], max(1, -(-(max(known) - min(known) + 1) // ranges)) if known else 1, (before, after)
    name = "key_hash"
    while name in after.columns:
        name += "_"
    # 32 bits of the hash, so that bounds and sums of ranges stay within a long.
    hashed = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), 32).alias(name)
    return name, max(1, (1 << 32) // ranges), tuple(df.select("*", hashed) for df in (before, after))


def differing_rows(before: DataFrame, after: DataFrame, keys, key: str, width: int, fanout: int = 16) -> DataFrame:
    """The net changes from ``before`` to ``after`` (``change_log``), reading rows of differing ranges of ``key`` only."""
    ranges = reconcile_ranges(before, after, key, width, fanout)
    b, a = (rows_in_ranges(df, key, ranges, width) for df in (before, after))
    return change_log(b, a.select(*before.columns), keys)
