"""Point-in-time history without an audit log: net changes between staged batches.

A table that has no audit log still arrives batch after batch. Each batch is
compared with the open intervals of its keys only; what changed closes the
open interval at the batch's time and opens a new one, what vanished (a
tombstone, or a key absent from a full load) closes it. Closed intervals are
never read again. One join on the key per batch, unique on both sides, so a
hot key cannot exist.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.keys import changed, key_match
from lakeloom.functions.literals import typed_lit
from lakeloom.operators.staging import DELETE_FLAG
from lakeloom.plans.workspace import empty_frame

FROM, TO, CURRENT = "valid_from", "valid_to", "is_current"
_O, _B = "o__", "b__"


def history_schema(business: T.StructType, time_type: T.DataType) -> T.StructType:
    """Business columns and the interval's."""
    own = [T.StructField(f.name, f.dataType, True) for f in business.fields]
    return T.StructType([*own, T.StructField(FROM, time_type), T.StructField(TO, time_type), T.StructField(CURRENT, T.BooleanType())])


def fold_batch(open_rows: DataFrame, batch: DataFrame, keys, at: Column, full: bool, compare_cols=None, protected: DataFrame | None = None, delete_col: str = DELETE_FLAG) -> DataFrame:
    """What a batch makes of the open intervals ``open_rows``: those that stay
    open, those it closes at ``at`` and those it opens.

    ``batch`` has one row per key and may flag tombstones in ``delete_col``. A
    full batch closes the intervals of absent keys, but for those in
    ``protected`` (keys whose row was rejected); an incremental one leaves
    them open. Columns that ``open_rows`` lacks are not kept. Equal NULLs are no change.
    """
    keys = list(keys)
    business = [c for c in open_rows.columns if c not in (FROM, TO, CURRENT)]
    compare = list(compare_cols) if compare_cols is not None else [c for c in business if c not in keys]
    flag = F.coalesce(F.col(delete_col), F.lit(False)) if delete_col in batch.columns else F.lit(False)
    b = batch.select(*[F.col(c).cast(open_rows.schema[c].dataType).alias(_B + c) for c in business], flag.alias(_B + "gone"), F.lit(False).alias(_B + "kept"))
    if full:
        # A full load holds whole rows only: tombstones are like absent keys.
        b = b.where(~F.col(_B + "gone"))
        if protected is not None:
            refused = protected.select(*[F.col(k).alias(_B + k) for k in keys]).distinct()
            refused = refused.join(b.select(*[_B + k for k in keys]), [_B + k for k in keys], "left_anti")
            b = b.unionByName(refused.withColumn(_B + "kept", F.lit(True)).withColumn(_B + "gone", F.lit(False)), allowMissingColumns=True)
    o = open_rows.select(*[F.col(c).alias(_O + c) for c in open_rows.columns])
    j = o.join(b, key_match(keys, _O, _B), "full_outer")
    held, given = F.col(_O + CURRENT).isNotNull(), F.col(_B + "gone").isNotNull()
    kept = F.coalesce(F.col(_B + "kept"), F.lit(False))
    gone = F.lit(full) & ~given | F.coalesce(F.col(_B + "gone"), F.lit(False))
    differs = given & ~kept & changed(compare, _B, _O)
    closes = held & (gone | differs)
    opens = given & ~kept & ~gone & (~held | differs)

    old = F.struct(*[F.col(_O + c).alias(c) for c in business], F.col(_O + FROM).alias(FROM), F.when(closes, at).alias(TO), (~closes).alias(CURRENT))
    new = F.struct(*[F.col(_B + c).alias(c) for c in business], at.alias(FROM), F.lit(None).cast(open_rows.schema[TO].dataType).alias(TO), F.lit(True).alias(CURRENT))
    rows = F.filter(F.array(F.when(held, old), F.when(opens, new)), lambda r: r.isNotNull())
    return j.select(F.explode(rows).alias("r")).select("r.*")


def history_from_batches(batches, keys, time_type: T.DataType = T.TimestampNTZType()) -> DataFrame:
    """Validity intervals of every key from ``batches``: ``(frame, time, full)``
    in order of their times, none twice."""
    closed, still_open = [], None
    for frame, at, full in batches:
        if still_open is None:
            business = T.StructType([f for f in frame.schema.fields if f.name != DELETE_FLAG])
            still_open = empty_frame(frame.sparkSession, history_schema(business, time_type))
        folded = fold_batch(still_open, frame, keys, typed_lit(at, time_type), full)
        closed.append(folded.where(~F.col(CURRENT)))
        still_open = folded.where(CURRENT)
    if still_open is None:
        raise ValueError("no batch")
    return reduce(DataFrame.unionByName, [*closed, still_open])
