"""Bitemporal history: what was valid when, as known when.

Every row is a rectangle: valid from .. to, known from .. to. A load brings
statements "from this time on the key has this state". It may come late and
correct the past: then the interval that holds its time is split. The
rectangle is closed in load time and its earlier part, with a new end, opened
again next to the correction. What a load does not touch stays as it is.

A load reads only the open rectangles of its keys. Ends come from the next
start of the key (``history.next_in_key``: a hot key is spread over buckets of
starts), then a rectangle whose end moved, or whose start was stated anew, is
closed and opened again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.literals import lit_like
from lakeloom.operators.history import DEFAULT_BUCKET_WIDTH, next_in_key

VALID_FROM, VALID_TO, KNOWN_FROM, KNOWN_TO, GONE = "valid_from", "valid_to", "known_from", "known_to", "is_deleted"
_NEW, _START = "_b_new", "_b_start"


def bitemporal_schema(payload: T.StructType, time_type: T.DataType, known_type: T.DataType) -> T.StructType:
    own = [T.StructField(f.name, f.dataType, True) for f in payload.fields]
    return T.StructType(
        [
            *own,
            T.StructField(GONE, T.BooleanType()),
            T.StructField(VALID_FROM, time_type),
            T.StructField(VALID_TO, time_type),
            T.StructField(KNOWN_FROM, known_type),
            T.StructField(KNOWN_TO, known_type),
        ]
    )


def _micros(col: str, dtype: T.DataType) -> Column:
    """An integral number that orders ``col`` without loss."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long")
    return F.col(col).cast("long")


def statements(batch: DataFrame, keys, time_col: str, seq_col: str, cols, op_col: str | None = None, delete_op: str = "D") -> DataFrame:
    """One statement per key and time: of several the one with the highest
    ``seq_col`` (combined map-side). Without ``op_col`` nothing is a deletion."""
    gone = F.coalesce(F.col(op_col) == F.lit(delete_op), F.lit(False)) if op_col else F.lit(False)
    said = F.max_by(F.struct(*cols, gone.alias(GONE)), seq_col).alias("s")
    return batch.where(F.col(time_col).isNotNull()).groupBy(*keys, F.col(time_col).alias(VALID_FROM)).agg(said).select(*keys, "s.*", VALID_FROM)


def apply_load(history: DataFrame, batch: DataFrame, keys, at, bucket_width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(untouched, rewritten)``: the rectangles of ``history`` that a load
    known from ``at`` leaves alone (closed ones, other keys), and the others
    as it makes them. ``batch`` is the outcome of :func:`statements`; ``at``
    must be later than the loads before."""
    keys = list(keys)
    known = lit_like(at, history, KNOWN_FROM)
    still_open = history.where(F.col(KNOWN_TO).isNull())
    same = _same_keys(keys)
    named = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    mine = still_open.join(named, same, "left_semi")
    untouched = history.where(F.col(KNOWN_TO).isNotNull()).unionByName(still_open.join(named, same, "left_anti"))

    # One row per key and start: what was open there, and what is stated anew.
    payload = [c for c in history.columns if c not in (*keys, VALID_FROM, VALID_TO, KNOWN_FROM, KNOWN_TO)]
    old = mine.select(*keys, VALID_FROM, F.struct(*payload, VALID_TO, KNOWN_FROM).alias("_b_old"))
    new = batch.select(*keys, VALID_FROM, F.struct(*[F.col(c).cast(history.schema[c].dataType).alias(c) for c in payload]).alias(_NEW))
    both = old.unionByName(new, allowMissingColumns=True)
    starts = both.groupBy(*keys, VALID_FROM).agg(F.first("_b_old", ignorenulls=True).alias("_b_old"), F.first(_NEW, ignorenulls=True).alias(_NEW))
    dtype = history.schema[VALID_FROM].dataType
    width = bucket_width or (86_400_000_000 if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else DEFAULT_BUCKET_WIDTH)
    starts = starts.withColumn(_START, _micros(VALID_FROM, dtype))
    nx = next_in_key(starts, keys, _START, [VALID_FROM], prefix="_n_", bucket_width=width)

    end = F.col(f"_n_{VALID_FROM}")
    was = F.col("_b_old").isNotNull()
    # A statement of what already holds changes nothing.
    differs = F.lit(False)
    for c in payload:
        differs = differs | ~F.col(f"_b_old.`{c}`").eqNullSafe(F.col(f"{_NEW}.`{c}`"))
    stated = F.col(_NEW).isNotNull() & (~was | differs)
    moved = was & (stated | ~F.col(f"_b_old.{VALID_TO}").eqNullSafe(end))
    ktype, vtype = history.schema[KNOWN_FROM].dataType, dtype

    def row(source: str, valid_to: Column, known_from: Column, known_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{source}.`{c}`").alias(c) for c in payload], F.col(VALID_FROM).alias(VALID_FROM), valid_to.cast(vtype).alias(VALID_TO),
            known_from.cast(ktype).alias(KNOWN_FROM), known_to.cast(ktype).alias(KNOWN_TO),
        )

    before = row("_b_old", F.col(f"_b_old.{VALID_TO}"), F.col(f"_b_old.{KNOWN_FROM}"), F.when(moved, known))
    after = F.when(stated, row(_NEW, end, known, F.lit(None))).when(moved, row("_b_old", end, known, F.lit(None)))
    rows = F.filter(F.array(F.when(was, before), after), lambda r: r.isNotNull())
    rewritten = nx.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*").select(*history.columns)
    return untouched, rewritten


def _same_keys(keys) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return same


def as_of(history: DataFrame, valid, known) -> DataFrame:
    """The state at time ``valid`` as it was known at ``known`` (both ends of
    an interval: from inclusive, to exclusive); deleted keys are left out."""
    v, k = lit_like(valid, history, VALID_FROM), lit_like(known, history, KNOWN_FROM)
    inside = (F.col(VALID_FROM) <= v) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > v))
    told = (F.col(KNOWN_FROM) <= k) & (F.col(KNOWN_TO).isNull() | (F.col(KNOWN_TO) > k))
    return history.where(inside & told & ~F.col(GONE)).drop(VALID_FROM, VALID_TO, KNOWN_FROM, KNOWN_TO, GONE)
