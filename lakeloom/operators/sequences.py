"""Which numbers of a growing sequence have been seen: islands, gaps, late entries.

An audit sequence is not seen in order: a transaction that took an earlier
number may become visible after later ones. What was consumed is therefore
kept as merged intervals, not as a single highest number.

Neighbours are found inside sequence buckets and across the first rows of
buckets (``history.next_in_key``), so no task sees the whole sequence; only
one row per bucket passes through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.asof import asof_join
from lakeloom.operators.history import DEFAULT_BUCKET_WIDTH, next_in_key

INTERVAL = "lo long, hi long"


def gaps(log: DataFrame, seq_col: str, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``lo, hi``: the stretches of numbers between the lowest and the highest
    that ``log`` lacks. Repeated numbers count once, NULLs not at all."""
    seen = log.select(F.col(seq_col).cast("long").alias("s")).where("s IS NOT NULL").distinct()
    nx = next_in_key(seen, [], "s", [], prefix="_n_", bucket_width=bucket_width)
    return nx.where("_n_s > s + 1").select((F.col("s") + 1).alias("lo"), (F.col("_n_s") - 1).alias("hi"))


def islands(log: DataFrame, seq_col: str, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``lo, hi``: the stretches of consecutive numbers in ``log``."""
    ends = log.agg(F.min(seq_col).cast("long").alias("first"), F.max(seq_col).cast("long").alias("last")).where("first IS NOT NULL")
    missing = gaps(log, seq_col, bucket_width)
    return _between(missing, ends, bucket_width)


def _between(missing: DataFrame, ends: DataFrame, bucket_width: int) -> DataFrame:
    """The complement of ``missing`` (``lo, hi``, apart) within ``first .. last``."""
    # Every gap ends an island; a gap past the last number ends the last one.
    starts = ends.select(F.col("first").alias("lo"), F.lit(None).cast("long").alias("stop"))
    cuts = missing.select((F.col("hi") + 1).alias("lo"), F.col("lo").alias("stop")).unionByName(starts)
    cuts = cuts.unionByName(ends.select((F.col("last") + 2).alias("lo"), (F.col("last") + 1).alias("stop")))
    nx = next_in_key(cuts, [], "lo", ["stop"], prefix="_n_", bucket_width=bucket_width)
    return nx.where("_n_lo IS NOT NULL").select("lo", (F.col("_n_stop") - 1).alias("hi"))


def merge_intervals(intervals: DataFrame, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """``lo, hi``: intervals that overlap or touch, merged.

    An interval's place in the running count of starts less ends tells where a
    merged one begins: counted per bucket and carried over one row per bucket.
    """
    w = int(bucket_width)
    i = intervals.where("lo <= hi")
    points = i.select(F.col("lo").alias("at"), F.lit(1).alias("step")).unionByName(i.select((F.col("hi") + 1).alias("at"), F.lit(-1).alias("step")))
    points = points.groupBy("at").agg(F.sum("step").alias("step"))
    points = points.withColumn("bkt", F.expr(f"(at - pmod(at, {w}L)) div {w}L"))
    open_before = points.groupBy("bkt").agg(F.sum("step").alias("n"))
    earlier = Window.orderBy("bkt").rowsBetween(Window.unboundedPreceding, -1)
    open_before = open_before.select("bkt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carried"))
    upto = Window.partitionBy("bkt").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = points.join(open_before, "bkt").select("at", "step", (F.col("carried") + F.sum("step").over(upto)).alias("open"))
    # A merged interval begins where the count leaves 0 and ends where it comes back.
    edges = level.where("open = 0 OR (open > 0 AND open - step = 0)").where("NOT (open = 0 AND step = 0)").select(F.col("at").alias("edge"), (F.col("open") > 0).alias("opens"))
    nx = next_in_key(edges, [], "edge", [], prefix="_n_", bucket_width=bucket_width)
    return nx.where("opens").select(F.col("edge").alias("lo"), (F.col("_n_edge") - 1).alias("hi"))


def unconsumed(log: DataFrame, seq_col: str, consumed: DataFrame, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Rows of ``log`` whose number lies in no interval of ``consumed`` (merged ``lo, hi``)."""
    c = consumed.select(F.col("lo").alias("_c_lo"), F.col("hi").alias("_c_hi"))
    held = log.select("*", F.col(seq_col).cast("long").alias("_c_seq"))
    found = asof_join(held, c, [], "_c_seq", "_c_lo", version_cols=["_c_hi"], bucket_width=bucket_width)
    return found.where("_c_hi IS NULL OR _c_hi < _c_seq").select(*log.columns)
