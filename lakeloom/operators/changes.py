"""Change capture: latest operation per key, snapshot diffs, applying change logs.

"Latest per key" is an aggregation (``max_by`` on the sequence), not a
ranked window: Spark combines it map-side, so a key holding a large share of
the log is reduced inside every task before the shuffle instead of being
sorted in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.keys import changed, key_match
from lakeloom.functions.literals import lit_like
from lakeloom.operators.merge import merge
from lakeloom.operators.staging import DELETE_FLAG



def latest_per_key(log: DataFrame, keys, seq_col: str, cols=None) -> DataFrame:
    """One row per key: the columns of the row with the highest ``seq_col``.

    The sequence must be unique per key (an audit id is); ``cols`` defaults to
    every non-key column. Each column is a ``max_by(col, seq)``: with
    fixed-width columns Spark plans a codegen'd hash aggregate, otherwise a
    sort aggregate; either way partial aggregation runs map-side.
    """
    keys = list(keys)
    cols = [c for c in (cols if cols is not None else log.columns) if c not in keys and c != seq_col]
    aggs = [F.max(seq_col).alias(seq_col)] + [F.max_by(c, seq_col).alias(c) for c in cols]
    return log.groupBy(*keys).agg(*aggs)


def window_filter(log: DataFrame, time_col: str | None, since=None, until=None) -> DataFrame:
    if time_col is None:
        return log
    if since is not None:
        log = log.where(F.col(time_col) >= lit_like(since, log, time_col))
    if until is not None:
        log = log.where(F.col(time_col) <= lit_like(until, log, time_col))
    return log


def latest_deleted_keys(
    log: DataFrame,
    keys,
    seq_col: str,
    op_col: str = "operation_type",
    delete_op: str = "D",
    time_col: str | None = None,
    since=None,
    until=None,
) -> DataFrame:
    """Keys whose most recent operation in the window is a delete.

    The window is on the operation time, so deleting a row that had not
    changed for a long time is still seen. A key deleted and re-inserted
    later is not in the set.
    """
    keys = list(keys)
    win = window_filter(log, time_col, since, until)
    # NULL keys cannot be deleted; filtering them here also makes every use of
    # this frame plan identically, so Spark can reuse its shuffle.
    for k in keys:
        win = win.where(F.col(k).isNotNull())
    # max_by over (boolean, sequence) keeps a fixed-width buffer: hash aggregate,
    # combined map-side, so a hot key is reduced in every task before the shuffle.
    is_delete = F.coalesce(F.col(op_col) == F.lit(delete_op), F.lit(False))
    last = win.groupBy(*keys).agg(F.max_by(is_delete, F.col(seq_col)).alias("_deleted"))
    return last.where(F.col("_deleted")).select(*keys)


def change_log(before: DataFrame, after: DataFrame, keys, compare_cols=None, payload: bool = True) -> DataFrame:
    """Net changes between two keyed snapshots.

    ``operation_type`` is I (key only after), D (key only before) or U (both,
    some column distinct); identical rows produce nothing. Payloads are JSON
    strings of the full row (``old_data`` for U/D, ``new_data`` for I/U), as a
    row trigger would log them. Unlike a trigger, a diff sees net change only:
    intermediate states and no-op updates between the snapshots are not logged.
    """
    keys = list(keys)
    cols = list(before.columns)
    compare = list(compare_cols) if compare_cols is not None else [c for c in cols if c not in keys]
    b = before.select(*[F.col(c).alias("b__" + c) for c in cols], F.lit(True).alias("b__in"))
    a = after.select(*[F.col(c).alias("a__" + c) for c in cols], F.lit(True).alias("a__in"))
    j = b.join(a, key_match(keys, "b__", "a__"), "full_outer")
    b_in, a_in = F.col("b__in").isNotNull(), F.col("a__in").isNotNull()
    op = F.when(~b_in, F.lit("I")).when(~a_in, F.lit("D")).otherwise(F.lit("U"))
    j = j.where(~b_in | ~a_in | changed(compare, "b__", "a__"))
    out = [F.coalesce(F.col("b__" + k), F.col("a__" + k)).alias(k) for k in keys] + [op.alias("operation_type")]
    if payload:
        out += [
            F.when(b_in, F.to_json(F.struct(*[F.col("b__" + c).alias(c) for c in cols]))).alias("old_data"),
            F.when(a_in, F.to_json(F.struct(*[F.col("a__" + c).alias(c) for c in cols]))).alias("new_data"),
        ]
    else:
        out += [F.col("b__" + c).alias("old_" + c) for c in compare] + [F.col("a__" + c).alias("new_" + c) for c in compare]
    return j.select(*out)


def parse_payload(df: DataFrame, col: str, schema) -> DataFrame:
    """Parse a JSON payload column back into typed fields (``{col}.field``)."""
    return df.withColumn(col, F.from_json(F.col(col), schema))


def changes_to_batch(
    log: DataFrame,
    keys,
    seq_col: str,
    op_col: str = "operation_type",
    delete_op: str = "D",
    cols=None,
    flag: str = DELETE_FLAG,
) -> DataFrame:
    """Collapse a change log to a staged batch: the latest row per key, with
    ``is_deleted`` set where that row is a delete. The sequence column is kept
    so a later merge can refuse to apply older rows."""
    keys = list(keys)
    cols = [c for c in (cols if cols is not None else log.columns) if c not in keys and c not in (seq_col, op_col)]
    is_delete = F.coalesce(F.col(op_col) == F.lit(delete_op), F.lit(False))
    aggs = [F.max(seq_col).alias(seq_col)] + [F.max_by(c, seq_col).alias(c) for c in cols]
    return log.groupBy(*keys).agg(*aggs, F.max_by(is_delete, seq_col).alias(flag))


def compact_log(
    log: DataFrame,
    keys,
    seq_col: str,
    op_col: str = "operation_type",
    cols=None,
    bucket_width: int | None = None,
    insert_op: str = "I",
    update_op: str = "U",
    delete_op: str = "D",
) -> DataFrame:
    """A raw change log folded to one net operation per key.

    Operations in a row combine as I+U=I, I+D=nothing, D+I=U, U+U=U, U+D=D: the
    first tells whether the key was there before, the last whether it is there
    after. That fold is associative, so every task reduces its rows first
    (``min_by`` / ``max_by`` on the sequence) and a key with a third of the log
    reaches the shuffle as one row per task. With ``bucket_width`` the fold is
    per (key, ``sequence div width``): the result is a smaller log, which can
    be folded again with what comes later; folding all of it gives the rows
    that folding the raw log gives.

    Returns keys, ``cols`` (of the last operation), ``op_col``, ``seq_col`` (of
    the last operation), ``first_seq``, ``first_op`` and ``n_ops``, which a
    further fold adds up. A NULL operation is an update. The sequence must be
    unique per key and not NULL.
    """
    keys = list(keys)
    folded = {"first_seq", "first_op", "n_ops"}
    again = folded <= set(log.columns)
    skip = {*keys, seq_col, op_col, *folded}
    cols = [c for c in (cols if cols is not None else log.columns) if c not in skip]
    op = F.coalesce(F.col(op_col), F.lit(update_op))
    # Of rows folded before, the operation that began them and their number.
    first_seq = F.col("first_seq") if again else F.col(seq_col)
    first_op = F.col("first_op") if again else op
    n_ops = F.sum("n_ops") if again else F.count(F.lit(1))
    bucket = []
    if bucket_width:
        w = int(bucket_width)
        bucket = [F.expr(f"(CAST(`{seq_col}` AS BIGINT) - pmod(CAST(`{seq_col}` AS BIGINT), {w}L)) div {w}L").alias("_c_bucket")]
    found = log.groupBy(*keys, *bucket).agg(
        F.max(seq_col).alias(seq_col),
        F.min(first_seq).alias("first_seq"),
        F.min_by(first_op, first_seq).alias("first_op"),
        F.max_by(op, seq_col).alias("_c_last"),
        *[F.max_by(c, seq_col).alias(c) for c in cols],
        n_ops.alias("n_ops"),
    )
    was = F.col("first_op") != insert_op
    net = F.when(F.col("_c_last") == delete_op, F.when(was, F.lit(delete_op))).otherwise(F.when(was, F.lit(update_op)).otherwise(F.lit(insert_op)))
    net = found.withColumn(op_col, net)
    if not bucket_width:
        # Inside buckets a key that came and went is kept: a later fold needs to know that it was not there before.
        net = net.where(F.col(op_col).isNotNull())
    else:
        net = net.withColumn(op_col, F.coalesce(op_col, F.lit(delete_op)))
    return net.select(*keys, *cols, op_col, seq_col, "first_seq", "first_op", "n_ops")


def snapshot_changes(table, from_version: int, to_version: int, keys, compare_cols=None, payload: bool = True) -> DataFrame:
    """``change_log`` between two versions of a ``SnapshotTable``.

    For a bucketed table only buckets whose data changed between the versions
    are read and diffed; untouched buckets are identical by construction, so
    the work follows the size of the change, not of the table.
    """
    if table.bucketed and table.commit(from_version).manifest is not None and table.commit(to_version).manifest is not None:
        changed_ids = table.changed_buckets(from_version, to_version)
        before = table.read(from_version, buckets=changed_ids)
        after = table.read(to_version, buckets=changed_ids)
    else:
        before, after = table.read(from_version), table.read(to_version)
    return change_log(before, after, keys, compare_cols, payload)


def apply_change_log(
    target: DataFrame,
    log: DataFrame,
    keys,
    seq_col: str,
    op_col: str = "operation_type",
    delete_op: str = "D",
    strategy: str = "auto",
) -> DataFrame:
    """Apply a change log to a keyed table: the latest operation per key wins;
    a delete removes the key, anything else upserts the logged row.

    The target's columns are taken from the log's latest row per key. The log
    is collapsed map-side first, so the merge sees one row per key.
    """
    batch = changes_to_batch(log, keys, seq_col, op_col, delete_op, cols=[c for c in target.columns if c not in keys])
    return merge(target, batch.select(*target.columns, DELETE_FLAG), keys, "incremental", strategy=strategy)
