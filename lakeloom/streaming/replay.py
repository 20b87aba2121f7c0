"""Change-log replay through Structured Streaming (extension).

Change-log files are read with ``readStream``; each micro-batch is collapsed
to the latest row per key and merged into a versioned state table with
``foreachBatch``. Two properties make the replay safe to rerun and
indifferent to the order files arrive in:

* the state keeps deletes as rows (``op = delete``) with their sequence, and
  a merge never lets an older sequence overwrite a newer one;
* a micro-batch that the same checkpoint already committed to the state last
  is skipped, so a restarted query does not apply a batch twice; logs read
  under other checkpoints are told apart and merged into the same state.

``current_rows`` then serves the live rows: the same result as applying the
whole log at once (``apply_change_log``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.changes import latest_per_key
from lakeloom.operators.merge import merge
from lakeloom.sources.snapshots import SnapshotTable

_BATCH_OP = "replay batch "
#: Log files are read however much older they are than the newest one seen: back-filled files count too.
MAX_FILE_AGE = "36500d"


def _token(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def _last_applied(newest, checkpoint: str) -> int:
    """Id of the last micro-batch of this checkpoint, if it made the newest
    commit; else -1. Batch ids only grow and only the latest batch can be
    delivered again after a failure. If another checkpoint's batch was
    committed since, the sequence guard makes applying it once more harmless."""
    start = f"{_BATCH_OP}{_token(checkpoint)}:"
    return int(newest.operation[len(start):]) if newest is not None and newest.operation.startswith(start) else -1


def apply_batch(state: SnapshotTable, batch: DataFrame, keys, seq_col: str, cols, batch_id: int, schema: T.StructType, checkpoint: str = "") -> None:
    newest = state.current()
    if batch_id <= _last_applied(newest, checkpoint):
        return
    operation = f"{_BATCH_OP}{_token(checkpoint)}:{batch_id}"
    latest = latest_per_key(batch, keys, seq_col, cols).select(*schema.fieldNames())
    touched = None
    if newest is None:
        # first micro-batch: the latest row per key is the state
        state.write(latest, operation=operation)
        return
    if state.bucketed and state.same_layout(newest):
        # Only the state buckets holding this batch's keys are read and rewritten.
        touched = state.touched_buckets(latest)
        target = state.read(buckets=touched)
    else:
        target = state.read()
    merged = merge(target, latest, keys, mode="incremental", newer_col=seq_col, strategy="full_outer")
    state.write(merged, operation=operation, replace_buckets=touched)


def _start(spark, log_path, log_schema, keys, seq_col, state_path, checkpoint_path, cols, max_files_per_trigger, buckets, trigger):
    keys = list(keys)
    cols = [c for c in (cols if cols is not None else log_schema.fieldNames()) if c not in keys and c != seq_col]
    schema = T.StructType([log_schema[c] for c in [*keys, seq_col, *cols]])
    state = SnapshotTable(spark, state_path, keys if buckets else None, buckets)
    stream = (
        spark.readStream.schema(log_schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", MAX_FILE_AGE)
        .parquet(log_path)
    )
    query = (
        stream.writeStream.foreachBatch(lambda df, bid: apply_batch(state, df, keys, seq_col, cols, bid, schema, checkpoint_path))
        .option("checkpointLocation", checkpoint_path)
        .trigger(**trigger)
        .start()
    )
    return state, query


def replay(
    spark: SparkSession,
    log_path: str,
    log_schema: T.StructType,
    keys,
    seq_col: str,
    state_path: str,
    checkpoint_path: str,
    cols=None,
    max_files_per_trigger: int = 1000,
    buckets: int = 0,
) -> SnapshotTable:
    """Replay every file under ``log_path`` into the state table and stop
    (``availableNow``). Returns the state table. ``buckets > 0`` keeps the
    state bucketed by key so each micro-batch rewrites only touched buckets."""
    state, query = _start(
        spark, log_path, log_schema, keys, seq_col, state_path, checkpoint_path, cols,
        max_files_per_trigger, buckets, {"availableNow": True},
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return state


def start_replay(
    spark: SparkSession,
    log_path: str,
    log_schema: T.StructType,
    keys,
    seq_col: str,
    state_path: str,
    checkpoint_path: str,
    cols=None,
    max_files_per_trigger: int = 1000,
    buckets: int = 0,
    processing_time: str = "1 minute",
):
    """Keep applying newly arriving change-log files every ``processing_time``.
    Returns ``(state_table, streaming_query)``; stop the query to end it. The
    same checkpoint location resumes where a stopped or failed run left off."""
    return _start(
        spark, log_path, log_schema, keys, seq_col, state_path, checkpoint_path, cols,
        max_files_per_trigger, buckets, {"processingTime": processing_time},
    )


def current_rows(state: SnapshotTable, op_col: str, delete_op: str = "D") -> DataFrame:
    """Live rows of the replayed state (a NULL operation is no delete)."""
    return state.read().where(~F.col(op_col).eqNullSafe(F.lit(delete_op)))
