import datetime as dt

from pyspark.sql import functions as F

from lakeloom.operators.changes import latest_per_key
from lakeloom.plans.workspace import work_dir
from lakeloom.streaming import replay


import pytest


@pytest.mark.parametrize("buckets", [0, 4])
def test_replay_is_order_insensitive_and_idempotent(spark, buckets):
    base = work_dir(spark, "replay_test")
    rows = [
        (1, 1, "I", 1.0), (1, 5, "U", 2.0), (2, 2, "I", 3.0), (2, 7, "D", None),
        (3, 3, "I", 4.0), (3, 8, "D", None), (3, 9, "I", 5.0), (4, 4, "U", 6.0),
    ]
    log = spark.createDataFrame(rows, "k long, seq long, op string, v double")
    # newest changes land in the first file, so micro-batches arrive out of order
    for i, part in enumerate([log.where("seq >= 7"), log.where("seq between 4 and 6"), log.where("seq < 4")]):
        part.coalesce(1).write.mode("append").parquet(f"{base}/log")
    state = replay.replay(spark, f"{base}/log", log.schema, ["k"], "seq", f"{base}/state", f"{base}/ckpt", cols=["op", "v"], max_files_per_trigger=1, buckets=buckets)
    got = sorted((r.k, r.seq, r.v) for r in replay.current_rows(state, "op", "D").collect())
    expected = latest_per_key(log, ["k"], "seq", ["op", "v"]).where(F.col("op") != "D")
    assert got == sorted((r.k, r.seq, r.v) for r in expected.collect()) == [(1, 5, 2.0), (3, 9, 5.0), (4, 4, 6.0)]
    n = state.current().version
    # a restart with the same checkpoint finds nothing new and changes nothing
    again = replay.replay(spark, f"{base}/log", log.schema, ["k"], "seq", f"{base}/state", f"{base}/ckpt", cols=["op", "v"], buckets=buckets)
    assert again.current().version == n
    # re-applying an already committed batch id is a no-op
    replay.apply_batch(state, log, ["k"], "seq", ["op", "v"], 0, state.read().schema, f"{base}/ckpt")
    assert state.current().version == n
    # a second log under a checkpoint of its own is merged, not skipped
    more = spark.createDataFrame([(2, 10, None, 7.0), (4, 3, "D", None), (5, 11, "I", 8.0)], log.schema)
    more.write.parquet(f"{base}/log2")
    replay.replay(spark, f"{base}/log2", log.schema, ["k"], "seq", f"{base}/state", f"{base}/ckpt2", cols=["op", "v"], buckets=buckets)
    got = sorted((r.k, r.seq, r.v) for r in replay.current_rows(state, "op", "D").collect())
    both = latest_per_key(log.unionByName(more), ["k"], "seq", ["op", "v"]).where(~F.col("op").eqNullSafe("D"))
    assert got == sorted((r.k, r.seq, r.v) for r in both.collect()) == [(1, 5, 2.0), (2, 10, 7.0), (3, 9, 5.0), (4, 4, 6.0), (5, 11, 8.0)]


def test_start_replay_picks_up_new_files(spark):
    base = work_dir(spark, "replay_live")
    schema = "k long, seq long, op string, v double"
    spark.createDataFrame([(1, 1, "I", 1.0)], schema).coalesce(1).write.parquet(f"{base}/log")
    log_schema = spark.read.parquet(f"{base}/log").schema
    state, query = replay.start_replay(
        spark, f"{base}/log", log_schema, ["k"], "seq", f"{base}/state", f"{base}/ckpt", cols=["op", "v"], processing_time="1 second"
    )
    try:
        query.processAllAvailable()
        spark.createDataFrame([(1, 2, "U", 2.0), (2, 3, "I", 3.0)], schema).coalesce(1).write.mode("append").parquet(f"{base}/log")
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted((r.k, r.v) for r in replay.current_rows(state, "op", "D").collect())
    assert got == [(1, 2.0), (2, 3.0)]
