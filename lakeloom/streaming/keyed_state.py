"""Change-log replay with the state in a key-value store.

``replay`` rewrites its state table (or the touched buckets of it) in every
micro-batch. Here the latest row of every key is the state of a streaming
aggregation, kept by RocksDB on the executors and checkpointed as a log of
changes: a micro-batch reads and writes the rows of its own keys and nothing
else, whatever the size of the state. Nothing expires: deletes stay as rows,
so an entry that arrives late never revives a key.

``max`` and ``max_by`` on the sequence do not depend on the order in which
entries arrive and an entry read twice changes nothing. They are combined
before the shuffle, so a hot key is one row per task.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.streaming.replay import MAX_FILE_AGE

#: Fixed at the first run of a checkpoint; later runs keep what it was made with.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def replay_keyed(
    spark: SparkSession,
    log_path: str,
    log_schema: T.StructType,
    keys,
    seq_col: str,
    checkpoint_path: str,
    cols=None,
    max_files_per_trigger: int = 1000,
) -> list[dict]:
    """Apply every log file that the checkpoint has not seen, however old it is,
    and stop. Returns the progress of the micro-batches: rows read, state rows
    in all and updated."""
    keys = list(keys)
    cols = [c for c in (cols if cols is not None else log_schema.fieldNames()) if c not in keys and c != seq_col]
    log = spark.readStream.schema(log_schema).option("maxFilesPerTrigger", max_files_per_trigger).option("maxFileAge", MAX_FILE_AGE).parquet(log_path)
    # An entry without sequence is older than any other; it holds only while its key has no other.
    seq = F.coalesce(F.col(seq_col).cast("long"), F.lit(-(1 << 63)))
    latest = log.withColumn("_k_seq", seq).groupBy(*keys).agg(F.max_by(F.struct(seq_col, *cols), "_k_seq").alias("latest"))
    with _settings(spark, STATE_STORE):
        query = latest.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
        query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return [
        {"rows": p["numInputRows"], "state_rows": s["numRowsTotal"], "updated": s["numRowsUpdated"]}
        for p in query.recentProgress
        for s in p["stateOperators"]
        if p["numInputRows"]
    ]


def state_rows(spark: SparkSession, checkpoint_path: str) -> DataFrame:
    """Keys, sequence and columns of the latest entry of every key, deletes included."""
    with _settings(spark, STATE_STORE):
        found = spark.read.format("statestore").load(checkpoint_path)
    value = found.schema["value"].dataType
    # The aggregate's buffer: the latest entry and the sequence it is ordered by.
    latest = next(f.name for f in value.fields if isinstance(f.dataType, T.StructType))
    return found.select("key.*", f"value.`{latest}`.*")


def live_rows(spark: SparkSession, checkpoint_path: str, op_col: str, delete_op: str = "D") -> DataFrame:
    """The rows of :func:`state_rows` whose latest entry is no delete (a NULL operation is none)."""
    return state_rows(spark, checkpoint_path).where(~F.col(op_col).eqNullSafe(F.lit(delete_op)))
