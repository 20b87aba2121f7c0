"""

``entry(spark)`` runs the flagship load on sf0.001; ``queries()`` maps each
operator to a callable ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
gives the DuckDB statement each result must equal (row count, schema and
values, order-insensitive).

Shared derivations used by several queries (the same on both sides):

* ``T`` (business-current target) = orders, with every 7th price bumped by one,
  so some rows differ from the batch, and every 10th key negated, so some keys
  of either side are absent from the other;
* ``S`` (staged batch) = orders in the incremental window
  [2000-01-01 - 1 day, 2001-08-01], every 13th key a tombstone.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from functools import reduce

# The driver may load this file by path from another working directory.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.literals import lit_like
from lakeloom.operators import asof, bitemporal, changes, checks, extract, history, merge, numbering, reconcile, sequences, staging
from lakeloom.plans import control as ctl
from lakeloom.plans import concurrent, pipeline
from lakeloom.plans.read_plan import balanced_ranges, partition_bounds
from lakeloom.plans.workspace import empty_frame, work_dir
from lakeloom.sources import files
from lakeloom.sources.snapshots import SnapshotTable
from lakeloom.spec import LoadMode, TableSpec
from lakeloom.streaming import keyed_state, replay

# The training-data operators are optional: without their folder the rest still works.
try:
    from lakeloom.llm import queries as llm_queries
except ImportError:
    llm_queries = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SF0001 = "/root/testdata/sf0.001"

RUN_FULL = dt.datetime(2000, 1, 1)
RUN_INCR = dt.datetime(2001, 8, 1)
HWM = dt.datetime(2000, 1, 1)
ONE_DAY = dt.timedelta(days=1)
EVENTS_SPLIT = dt.datetime(2024, 1, 15)
DELETE_SINCE = dt.datetime(2024, 1, 20)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _target(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    bumped = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return o.select(_shifted("o_orderkey", 10), "o_orderstatus", bumped.alias("o_totalprice"))


def _shifted(key: str, every: int):
    """The key, negated for every n-th row: absent from the unshifted side without dropping a row."""
    return F.when(F.col(key) % every == 0, -F.col(key) - 1).otherwise(F.col(key)).alias(key)


def _staged(spark, sf) -> DataFrame:
    o = extract.extract_incremental(_t(spark, sf, "orders"), "o_orderdate", HWM, RUN_INCR, ONE_DAY)
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice", (F.col("o_orderkey") % 13 == 0).alias("is_deleted"))


KEYS = ["o_orderkey"]


def _audit_events(spark, sf) -> DataFrame:
    """The events table read as an audit log: error = delete, signup = insert, else update."""
    e = _t(spark, sf, "events")
    op = F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U")
    return e.withColumn("operation_type", op)


# --------------------------------------------------------------------------- queries


def q_high_water_mark(spark, sf):
    return extract.high_water_mark(_t(spark, sf, "orders"), "o_orderdate")


def q_high_water_mark_seq(spark, sf):
    return extract.high_water_mark_seq(_t(spark, sf, "orders"), "o_orderkey")


def q_extract_full(spark, sf):
    return extract.extract_full(_t(spark, sf, "orders"), "o_orderdate", RUN_FULL)


def q_extract_full_unbounded(spark, sf):
    return extract.extract_full(_t(spark, sf, "customer"))


def q_extract_incremental(spark, sf):
    return extract.extract_incremental(_t(spark, sf, "orders"), "o_orderdate", HWM, dt.datetime(2001, 1, 1), ONE_DAY)


def q_extract_incremental_seq(spark, sf):
    return extract.extract_incremental(_t(spark, sf, "orders"), "o_orderkey", 1000, 1400, overlap=100)


def q_number_rows(spark, sf):
    return numbering.number_rows(_t(spark, sf, "orders"), ["o_orderkey"])


def q_partition_bounds(spark, sf):
    return partition_bounds(_t(spark, sf, "orders"), "o_orderkey")


def q_csv_ingest(spark, sf):
    base = work_dir(spark, "csv_ingest")
    files.write_csv(_t(spark, sf, "region").select("r_regionkey", "r_name"), f"{base}/csv")
    schema = T.StructType([T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())])
    table = SnapshotTable(spark, f"{base}/region")
    files.ingest_csv(spark, f"{base}/csv", schema, table)
    return table.read()


def q_empty_table(spark, sf):
    """A table created empty from the schema of part, then loaded: what it held
    before (nothing) and after."""
    part = _t(spark, sf, "part")
    table = SnapshotTable(spark, work_dir(spark, "empty_table"))
    made = table.create_empty(part.schema)
    table.write(merge.merge(table.read(), part, ["p_partkey"], "incremental"))
    held = [table.read(made.version).withColumn("version", F.lit(0)), table.read().withColumn("version", F.lit(1))]
    return held[0].unionByName(held[1])


def q_latest_deleted_keys(spark, sf):
    return changes.latest_deleted_keys(
        _audit_events(spark, sf), ["user_id"], "event_id", "operation_type", "D",
        time_col="ts", since=DELETE_SINCE - ONE_DAY,
    )


def q_stage_batch(spark, sf):
    o = _t(spark, sf, "orders")
    live = o.where(F.col("o_orderkey") % 13 != 0).select("o_orderkey", "o_orderstatus", "o_totalprice")
    deletes = o.where(F.col("o_orderkey") % 13 == 0).select("o_orderkey")
    return staging.stage_batch(live, deletes)


PART_SCHEMA = T.StructType(
    [
        T.StructField("part_key", T.IntegerType(), False),
        T.StructField("part_name", T.StringType(), True),
        T.StructField("unit_price", T.DecimalType(10, 2), True),
    ]
)


def q_conform_schema(spark, sf):
    rename = {"part_key": "p_partkey", "part_name": "p_name", "unit_price": "p_retailprice"}
    return staging.conform_schema(_t(spark, sf, "part"), PART_SCHEMA, rename)


def q_conform_rejects(spark, sf):
    # Every third row has a number there, which casts.
    digit = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey").cast("string")).otherwise(F.col("o_orderpriority"))
    o = _t(spark, sf, "orders").select("o_orderkey", digit.alias("o_orderpriority"))
    return staging.cast_rejects(o, {"o_orderpriority": "int"})


def q_stage_count_check(spark, sf):
    base = work_dir(spark, "stage_count_check")
    spec = TableSpec("orders", ("o_orderkey",), LoadMode.FULL)
    res = pipeline.stage_table(
        spark, spec, _t(spark, sf, "orders"), None,
        SnapshotTable(spark, f"{base}/staging"), ctl.ControlTable(spark, f"{base}/_control"), RUN_FULL,
    )
    return res.check.to_frame(spark)


def q_insert_keys(spark, sf):
    return merge.insert_keys(_target(spark, sf), _staged(spark, sf), KEYS)


def q_delete_keys(spark, sf):
    return merge.delete_keys(_target(spark, sf), _staged(spark, sf), KEYS)


def q_changed_rows(spark, sf):
    return merge.changed_keys(_target(spark, sf), _staged(spark, sf), KEYS, ["o_orderstatus", "o_totalprice"])


def q_merge_incremental(spark, sf):
    return merge.merge(_target(spark, sf), _staged(spark, sf), KEYS, "incremental", strategy="auto")


def q_merge_incremental_shuffle(spark, sf):
    return merge.merge(_target(spark, sf), _staged(spark, sf), KEYS, "incremental", strategy="full_outer")


def q_merge_incremental_broadcast(spark, sf):
    return merge.merge(_target(spark, sf), _staged(spark, sf), KEYS, "incremental", strategy="broadcast")


def q_merge_full(spark, sf):
    return merge.merge(_target(spark, sf), _staged(spark, sf), KEYS, "full")


def q_merge_expected_count(spark, sf):
    return merge.expected_count(merge.merge_actions(_target(spark, sf), _staged(spark, sf), KEYS, "incremental", strategy="full_outer"))


def q_snapshot_restore(spark, sf):
    table = SnapshotTable(spark, work_dir(spark, "snapshot_restore"))
    v0, _ = table.write(_target(spark, sf))
    v1, _ = table.write(merge.merge(table.read(v0.version), _staged(spark, sf), KEYS, "incremental"))
    table.restore(v0.version)
    # What readers get, and the rolled-back version next to it.
    return table.read().withColumn("version", F.lit(2)).unionByName(table.read(v1.version).withColumn("version", F.lit(1)))


def q_pending_versions(spark, sf):
    base = work_dir(spark, "pending_versions")
    table = SnapshotTable(spark, f"{base}/orders")
    orders = _t(spark, sf, "orders")
    # One incremental extract per year of order dates, each a version.
    for year in range(1995, 2002):
        lo, hi = dt.datetime(year, 1, 1), dt.datetime(year, 12, 31, 23, 59, 59)
        table.write(extract.extract_incremental(orders, "o_orderdate", lo, hi, dt.timedelta(0)))
    control = ctl.ControlTable(spark, f"{base}/_control")
    control.mark_consumed("orders", 1, RUN_FULL)
    control.record_skip("orders", 3, RUN_FULL)
    # The rows that a reader of the pending versions has yet to see.
    pending = [r["version"] for r in ctl.pending_versions(table.history(), control.frame(), "orders").collect()]
    return reduce(DataFrame.unionByName, (table.read(v).withColumn("version", F.lit(v)) for v in sorted(pending)))


def q_change_log(spark, sf):
    before = _target(spark, sf)
    after = _staged(spark, sf).where(~F.col("is_deleted")).drop("is_deleted")
    log = changes.change_log(before, after, KEYS)
    payload = before.schema
    log = changes.parse_payload(changes.parse_payload(log, "old_data", payload), "new_data", payload)
    return log.select(
        "o_orderkey", "operation_type",
        F.col("old_data.o_totalprice").alias("old_price"), F.col("new_data.o_totalprice").alias("new_price"),
    )


def q_change_log_versions(spark, sf):
    """Change log between two versions of a bucketed table: T as v0, the batch
    merged bucket-scoped as v1; only changed buckets are diffed."""
    table = SnapshotTable(spark, work_dir(spark, "change_log_versions"), KEYS, 16)
    v0, _ = table.write(_target(spark, sf))
    batch = _staged(spark, sf)
    touched = table.touched_buckets(batch)
    v1, _ = table.write(merge.merge(table.read(buckets=touched), batch, KEYS, "incremental"), replace_buckets=touched)
    log = changes.snapshot_changes(table, v0.version, v1.version, KEYS)
    payload = _target(spark, sf).schema
    log = changes.parse_payload(changes.parse_payload(log, "old_data", payload), "new_data", payload)
    return log.select(
        "o_orderkey", "operation_type",
        F.col("old_data.o_totalprice").alias("old_price"), F.col("new_data.o_totalprice").alias("new_price"),
    )


def q_apply_change_log(spark, sf):
    """Two daily change batches (before / from 2024-01-15) applied in turn:
    latest op per key → tombstones → incremental merge."""
    audit = _audit_events(spark, sf).select("user_id", "event_id", "value", "operation_type", "ts")
    state = empty_frame(spark, "user_id long, event_id long, value double")
    split = lit_like(EVENTS_SPLIT, audit, "ts")
    for part in (audit.where(F.col("ts") < split), audit.where(F.col("ts") >= split)):
        state = changes.apply_change_log(state, part.drop("ts"), ["user_id"], "event_id", strategy="full_outer")
    return state


def q_check_primary_key(spark, sf):
    return checks.duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_check_not_null(spark, sf):
    return checks.null_counts(_t(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], {"o_orderstatus": "P"})


def q_check_foreign_key(spark, sf):
    parents = _t(spark, sf, "customer").select(_shifted("c_custkey", 5))
    return checks.orphans(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), parents, ["o_custkey"], ["c_custkey"])


def q_history_scd2(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return history.scd2(e, ["user_id"], "event_id", "ts", cols=["event_type", "ts"])


def q_history_scd2_deletes(spark, sf):
    """Intervals that a delete (here: an error event) ends; deletes are no versions."""
    e = _audit_events(spark, sf).select("user_id", "event_id", "event_type", "ts", "operation_type")
    return history.scd2(e, ["user_id"], "event_id", "ts", cols=["event_type", "ts"], op_col="operation_type")


def q_as_of(spark, sf):
    return history.as_of(_t(spark, sf, "events"), ["user_id"], "event_id", "ts", EVENTS_SPLIT)


def q_stream_replay(spark, sf, buckets: int = 0):
    base = work_dir(spark, "stream_replay")
    log = _t(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    # The change log lands as several files; each becomes its own micro-batch.
    log.repartitionByRange(4, "event_id").write.parquet(f"{base}/log")
    state = replay.replay(
        spark, f"{base}/log", log.schema, ["user_id"], "event_id",
        f"{base}/state", f"{base}/_checkpoint", cols=["event_type", "value"], buckets=buckets,
    )
    return replay.current_rows(state, "event_type", "error").select("user_id", "event_id", "value")


def q_stream_replay_bucketed(spark, sf):
    """Replay with the state bucketed by key: each micro-batch rewrites only touched buckets."""
    return q_stream_replay(spark, sf, buckets=16)


def q_load_pipeline(spark, sf, buckets: int = 0, bucket_width: int | None = None):
    """Flagship: full load of orders as of 2000-01-01 (v0), then an
    incremental batch to 2001-08-01 with deletes from the audit log (v1)."""
    base = work_dir(spark, "load_pipeline")
    orders = _t(spark, sf, "orders")
    source_after = orders.where(F.col("o_orderkey") % 13 != 0)  # rows deleted from the source by then
    audit = orders.where(F.col("o_orderkey") % 13 == 0).select(
        "o_orderkey",
        F.col("o_orderkey").alias("audit_id"),
        F.lit("D").alias("operation_type"),
        F.col("o_orderdate").alias("operation_timestamp"),
    )
    stg = SnapshotTable(spark, f"{base}/staging")
    bucketed = buckets or bucket_width
    cur = SnapshotTable(spark, f"{base}/current", ("o_orderkey",) if bucketed else None, buckets, bucket_width=bucket_width)
    control = ctl.ControlTable(spark, f"{base}/_control")
    full = TableSpec("orders", ("o_orderkey",), LoadMode.FULL, update_col="o_orderdate")
    pipeline.stage_table(spark, full, orders, None, stg, control, RUN_FULL)
    pipeline.merge_table(spark, full, stg, cur, control, RUN_FULL)
    incr = TableSpec("orders", ("o_orderkey",), LoadMode.INCREMENTAL, update_col="o_orderdate", audit_seq_col="audit_id")
    pipeline.stage_table(spark, incr, source_after, audit, stg, control, RUN_INCR)
    pipeline.merge_table(spark, incr, stg, cur, control, RUN_INCR)
    return cur.read()


def q_load_pipeline_recovered(spark, sf):
    """Three stage jobs (one per span of order dates, the later ones repeating a
    day) with a failed merge before the last: the retry merges every batch."""
    base = work_dir(spark, "load_pipeline_recovered")
    orders = _t(spark, sf, "orders")
    stg, cur = SnapshotTable(spark, f"{base}/staging"), SnapshotTable(spark, f"{base}/current", ("o_orderkey",), 16)
    control = ctl.ControlTable(spark, f"{base}/_control")
    spec = TableSpec("orders", ("o_orderkey",), LoadMode.INCREMENTAL, update_col="o_orderdate")
    pipeline.stage_table(spark, spec, orders, None, stg, control, dt.datetime(1998, 1, 1))
    pipeline.stage_table(spark, spec, orders, None, stg, control, RUN_FULL)
    try:
        pipeline.merge_table(spark, spec, stg, cur, control, RUN_FULL, expected_override=-1)
    except checks.CheckFailed:
        pass
    pipeline.stage_table(spark, spec, orders, None, stg, control, RUN_INCR)
    pipeline.merge_table(spark, spec, stg, cur, control, RUN_INCR)
    return cur.read()


def q_merge_full_with_rejects(spark, sf):
    """A full load over T in which every third price cannot be read: those keys keep their stored rows."""
    base = work_dir(spark, "merge_full_with_rejects")
    stg, cur = SnapshotTable(spark, f"{base}/staging"), SnapshotTable(spark, f"{base}/current")
    control = ctl.ControlTable(spark, f"{base}/_control")
    cur.write(_target(spark, sf))
    price = F.when(F.col("o_orderkey") % 3 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    source = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"))
    spec = TableSpec("orders", ("o_orderkey",), LoadMode.FULL, staging_schema=_target(spark, sf).schema)
    pipeline.stage_table(spark, spec, source, None, stg, control, RUN_FULL)
    pipeline.merge_table(spark, spec, stg, cur, control, RUN_FULL)
    return cur.read()


def q_load_pipeline_bucketed(spark, sf):
    """The flagship with the current table bucketed by key (bucket-scoped merge)."""
    return q_load_pipeline(spark, sf, buckets=32)


def q_load_pipeline_range_bucketed(spark, sf):
    """The flagship with the current table range-bucketed on the order key."""
    return q_load_pipeline(spark, sf, bucket_width=4096)


# --- history, as-of joins, reconciliation, compaction


def _orders_on(spark, sf, run: int):
    """The source as three runs see it: orders up to a date, some prices changed since the run before, some rows gone."""
    upto = (dt.datetime(1998, 1, 1), RUN_FULL, RUN_INCR)[run]
    o = extract.extract_full(_t(spark, sf, "orders"), "o_orderdate", upto).where(F.col("o_orderkey") % 11 != run)
    price = F.when(F.col("o_orderkey") % 5 == run, F.col("o_totalprice") + run + 1).otherwise(F.col("o_totalprice"))
    return o.select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"))


HISTORY_RUNS = (dt.datetime(1998, 1, 1), RUN_FULL, RUN_INCR, dt.datetime(2001, 9, 1))


def q_history_from_batches(spark, sf):
    """A point-in-time layer without audit log, from what is staged: three full
    loads, the layer built after the first and after the third, then an
    incremental batch with tombstones."""
    base = work_dir(spark, "history_from_batches")
    stg, hist = SnapshotTable(spark, f"{base}/staging"), SnapshotTable(spark, f"{base}/history", KEYS, 16)
    control = ctl.ControlTable(spark, f"{base}/_control")
    full = TableSpec("orders", ("o_orderkey",), LoadMode.FULL, point_in_time=True)
    for run in range(3):
        pipeline.stage_table(spark, full, _orders_on(spark, sf, run), None, stg, control, HISTORY_RUNS[run])
        if run != 1:
            pipeline.build_history_from_batches(full, stg, hist)
    deleted = _t(spark, sf, "orders").where(F.col("o_orderkey") % 17 == 0).select(
        "o_orderkey", F.col("o_orderkey").alias("audit_id"), F.lit("D").alias("operation_type"), F.lit(HISTORY_RUNS[3].isoformat()).cast("timestamp_ntz").alias("operation_timestamp")
    )
    again = _orders_on(spark, sf, 2).where(F.col("o_orderkey") % 19 == 0).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    incr = TableSpec("orders", ("o_orderkey",), LoadMode.INCREMENTAL, update_col="o_orderkey", audit_seq_col="audit_id", overlap=0)
    pipeline.stage_table(spark, incr, again, deleted, stg, control, HISTORY_RUNS[3])
    pipeline.build_history_from_batches(incr, stg, hist)
    return hist.read()


def q_history_late(spark, sf):
    """A point-in-time layer whose audit log shows a seventh of its entries late: each build finds them."""
    audit = _audit_events(spark, sf).select("user_id", "event_id", "event_type", "ts", "operation_type")
    spec = TableSpec("events", ("user_id",), audit_seq_col="event_id", audit_time_col="ts", point_in_time=True)
    table = SnapshotTable(spark, work_dir(spark, "history_late"), ["user_id"], 16)
    highest = audit.agg(F.max("event_id")).first()[0]
    for seen in ((F.col("event_id") % 7 != 3) & (F.col("event_id") <= highest // 2), F.col("event_id") % 7 != 3, F.lit(True)):
        pipeline.build_history(spec, audit.where(seen), table)
    return table.read().drop("operation_type")


def q_audit_gaps(spark, sf):
    """Numbers missing from the audit sequence while some entries are not visible yet."""
    seen = (F.col("event_id") % 97 != 0) & ~F.pmod(F.col("event_id"), F.lit(1009)).between(500, 520)
    return sequences.gaps(_t(spark, sf, "events").where(seen), "event_id", bucket_width=256)


def q_asof_join(spark, sf):
    """Purchases with the state of their user, an SCD2 history of the other events that errors end."""
    e = _audit_events(spark, sf)
    states = history.scd2(e.where(F.col("event_type") != "purchase").select("user_id", "event_id", "event_type", "value", "ts", "operation_type"), ["user_id"], "event_id", "ts", cols=["event_id", "event_type", "value", "ts"], op_col="operation_type")
    states = states.select("user_id", F.col("event_id").alias("state_id"), F.col("event_type").alias("state"), F.col("value").alias("state_value"), "valid_from", "valid_to")
    purchases = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return asof.asof_join(purchases, states, ["user_id"], "ts", "valid_from", ["state_id", "state", "state_value"], version_seq="state_id", valid_to="valid_to")


def _orders_changed(spark, sf):
    """Orders, but for a few rows that differ, are gone or are new."""
    o = _t(spark, sf, "orders").where(F.col("o_orderkey") % 1499 != 7)
    price = F.when(F.col("o_orderkey") % 997 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    key = F.when(F.col("o_orderkey") % 2003 == 11, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    return o.withColumn("o_totalprice", price).withColumn("o_orderkey", key)


RANGE_WIDTH = 64


def q_reconcile_ranges(spark, sf):
    """Key ranges in which two copies of orders differ, found by comparing digests from the root."""
    return reconcile.reconcile_ranges(_t(spark, sf, "orders"), _orders_changed(spark, sf), "o_orderkey", RANGE_WIDTH)


def q_reconcile_rows(spark, sf):
    """The rows that differ, read from the differing ranges only."""
    log = reconcile.differing_rows(_t(spark, sf, "orders"), _orders_changed(spark, sf), KEYS, "o_orderkey", RANGE_WIDTH)
    return log.select("o_orderkey", "operation_type")


def q_merge_incremental_bloom(spark, sf):
    return merge.merge(_target(spark, sf), _staged(spark, sf), KEYS, "incremental", strategy="bloom")


def _raw_log(spark, sf):
    """Events as a raw change log: signup = insert, error = delete, else update."""
    return _audit_events(spark, sf).select("user_id", "event_id", "value", "operation_type")


def q_compact_log(spark, sf):
    """One net operation per user, folded per sequence bucket first, then over buckets."""
    parts = changes.compact_log(_raw_log(spark, sf), ["user_id"], "event_id", bucket_width=64)
    return changes.compact_log(parts, ["user_id"], "event_id", cols=["value"])


BITEMPORAL_LOADS = tuple(dt.datetime(2024, 1, d) for d in (8, 15, 22, 29))
BITEMPORAL_POINTS = tuple((dt.datetime(2024, 1, v), dt.datetime(2024, 1, k)) for v, k in ((5, 8), (5, 29), (14, 22), (25, 29)))


def q_bitemporal_as_of(spark, sf):
    """Weekly loads, in which every fifth event arrives a week late and corrects
    the past; the state at four pairs of valid time and load time."""
    e = _audit_events(spark, sf).select("user_id", "event_id", "value", "operation_type", "ts")
    late = F.when(F.col("event_id") % 5 == 0, F.col("ts") + F.expr("INTERVAL 7 DAYS")).otherwise(F.col("ts"))
    payload = T.StructType([e.schema[c] for c in ("user_id", "event_id", "value")])
    held = empty_frame(spark, bitemporal.bitemporal_schema(payload, T.TimestampNTZType(), T.TimestampNTZType()))
    table = SnapshotTable(spark, work_dir(spark, "bitemporal"))
    before = dt.datetime(1900, 1, 1)
    for at in BITEMPORAL_LOADS:
        batch = e.where((late > lit_like(before, e, "ts")) & (late <= lit_like(at, e, "ts")))
        said = bitemporal.statements(batch, ["user_id"], "ts", "event_id", ["event_id", "value"], op_col="operation_type")
        table.write(reduce(DataFrame.unionByName, bitemporal.apply_load(held, said, ["user_id"], at)))
        held, before = table.read(), at
    found = [bitemporal.as_of(held, v, k).withColumn("point", F.lit(i)) for i, (v, k) in enumerate(BITEMPORAL_POINTS)]
    return reduce(DataFrame.unionByName, found)


def q_stream_replay_state(spark, sf):
    """Replay with the latest row per key in a key-value store: a micro-batch costs its own keys only."""
    base = work_dir(spark, "stream_replay_state")
    log = _t(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    log.repartitionByRange(4, "event_id").write.parquet(f"{base}/log")
    keyed_state.replay_keyed(spark, f"{base}/log", log.schema, ["user_id"], "event_id", f"{base}/_checkpoint", cols=["event_type", "value"], max_files_per_trigger=2)
    return keyed_state.live_rows(spark, f"{base}/_checkpoint", "event_type", "error").select("user_id", "event_id", "value")


def q_stream_replay_backfill(spark, sf):
    """Replay of the newer half of the log, then of the older half in files a month older."""
    base = work_dir(spark, "stream_replay_backfill")
    log = _t(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    newer = F.col("event_id") % 2 == 0
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/log")
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    for half, days in ((newer, 0), (~newer, 30)):
        held = {f.getPath().getName() for f in files.listStatus(hadoop)} if days else set()
        log.where(half).repartition(2).write.mode("append").parquet(f"{base}/log")
        for f in files.listStatus(hadoop):
            if days and f.getPath().getName() not in held:
                files.setTimes(f.getPath(), f.getModificationTime() - days * 86_400_000, -1)
        state = replay.replay(spark, f"{base}/log", log.schema, ["user_id"], "event_id", f"{base}/state", f"{base}/_checkpoint", cols=["event_type", "value"])
    return replay.current_rows(state, "event_type", "error").select("user_id", "event_id", "value")


def q_balanced_ranges(spark, sf):
    """Ranges of a skewed key (half the rows have one of seven values): all rows,
    ranges whose predicate does not give the rows they promise, and ranges over
    1.2 times the mean that more than one key shares."""
    rows = _t(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 2 == 0, F.col("l_partkey") % 7).otherwise(F.col("l_partkey")).alias("k"))
    ranges = balanced_ranges(rows, "k", 8)
    found = rows.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.expr(r.predicate("k"))).alias(f"n{i}") for i, r in enumerate(ranges)],
        *[F.count_distinct(F.when(F.expr(r.predicate("k")), F.col("k"))).alias(f"d{i}") for i, r in enumerate(ranges)],
    )
    wrong = sum(((F.col(f"n{i}") != r.rows).cast("int") for i, r in enumerate(ranges)), F.lit(0))
    large = sum((((F.col(f"n{i}") > 1.2 * F.col("total") / 8) & (F.col(f"d{i}") > 1)).cast("int") for i in range(len(ranges))), F.lit(0))
    return found.select("total", wrong.alias("wrong"), large.alias("too_large"))


def q_load_parallel(spark, sf):
    """Region, nation and customer side by side as far as their keys allow, then orders: the loaded orders."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey"}
    parents = {"nation": (("n_regionkey", "region", "r_regionkey"),), "customer": (("c_nationkey", "nation", "n_nationkey"),), "orders": (("o_custkey", "customer", "c_custkey"),)}
    specs = [TableSpec(n, (k,), LoadMode.FULL, foreign_keys=parents.get(n, ())) for n, k in keys.items()]
    base = work_dir(spark, "load_parallel")
    concurrent.load_tables(spark, specs, {n: _t(spark, sf, n) for n in keys}, {}, base, RUN_INCR)
    layout = pipeline.Layout(base)
    o, c = (layout.current(spark, specs[i]).read() for i in (3, 2))
    return o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").select("o_orderkey", "o_custkey", "c_nationkey", "o_totalprice")


def entry(spark: SparkSession) -> DataFrame:
    return q_load_pipeline(spark, SF0001)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _queries()
    if llm_queries:
        found |= llm_queries.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _oracle_sql()
    if llm_queries:
        found |= llm_queries.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "high_water_mark": q_high_water_mark,
        "high_water_mark_seq": q_high_water_mark_seq,
        "extract_full": q_extract_full,
        "extract_full_unbounded": q_extract_full_unbounded,
        "extract_incremental": q_extract_incremental,
        "extract_incremental_seq": q_extract_incremental_seq,
        "number_rows": q_number_rows,
        "partition_bounds": q_partition_bounds,
        "csv_ingest": q_csv_ingest,
        "empty_table": q_empty_table,
        "latest_deleted_keys": q_latest_deleted_keys,
        "stage_batch": q_stage_batch,
        "conform_schema": q_conform_schema,
        "conform_rejects": q_conform_rejects,
        "stage_count_check": q_stage_count_check,
        "insert_keys": q_insert_keys,
        "delete_keys": q_delete_keys,
        "changed_rows": q_changed_rows,
        "merge_incremental": q_merge_incremental,
        "merge_incremental_shuffle": q_merge_incremental_shuffle,
        "merge_incremental_broadcast": q_merge_incremental_broadcast,
        "merge_full": q_merge_full,
        "merge_expected_count": q_merge_expected_count,
        "snapshot_restore": q_snapshot_restore,
        "pending_versions": q_pending_versions,
        "change_log": q_change_log,
        "change_log_versions": q_change_log_versions,
        "apply_change_log": q_apply_change_log,
        "check_primary_key": q_check_primary_key,
        "check_not_null": q_check_not_null,
        "check_foreign_key": q_check_foreign_key,
        "history_scd2": q_history_scd2,
        "history_scd2_deletes": q_history_scd2_deletes,
        "as_of": q_as_of,
        "stream_replay": q_stream_replay,
        "stream_replay_bucketed": q_stream_replay_bucketed,
        "load_pipeline": q_load_pipeline,
        "load_pipeline_recovered": q_load_pipeline_recovered,
        "merge_full_with_rejects": q_merge_full_with_rejects,
        "load_pipeline_bucketed": q_load_pipeline_bucketed,
        "load_pipeline_range_bucketed": q_load_pipeline_range_bucketed,
        "history_from_batches": q_history_from_batches,
        "history_late": q_history_late,
        "audit_gaps": q_audit_gaps,
        "asof_join": q_asof_join,
        "reconcile_ranges": q_reconcile_ranges,
        "reconcile_rows": q_reconcile_rows,
        "merge_incremental_bloom": q_merge_incremental_bloom,
        "compact_log": q_compact_log,
        "bitemporal_as_of": q_bitemporal_as_of,
        "stream_replay_state": q_stream_replay_state,
        "stream_replay_backfill": q_stream_replay_backfill,
        "balanced_ranges": q_balanced_ranges,
        "load_parallel": q_load_parallel,
    }


# --------------------------------------------------------------------------- oracles

_T_SQL = (
    "T AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 "
    "ELSE o_totalprice END AS o_totalprice FROM orders)"
)
_S_SQL = (
    "S AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderkey % 13 = 0 AS is_deleted FROM orders "
    "WHERE o_orderdate BETWEEN TIMESTAMP '2000-01-01' - INTERVAL 1 DAY AND TIMESTAMP '2001-08-01')"
)
_TS = f"WITH {_T_SQL}, {_S_SQL} "

_RUNS_SQL = (
    "st AS (SELECT 0 AS r, o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice "
    "FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' AND o_orderkey % 11 <> 0 "
    "UNION ALL SELECT 1, o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice + 2 ELSE o_totalprice END "
    "FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01' AND o_orderkey % 11 <> 1 "
    "UNION ALL SELECT 2, o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 2 THEN o_totalprice + 3 ELSE o_totalprice END "
    "FROM orders WHERE o_orderdate <= TIMESTAMP '2001-08-01' AND o_orderkey % 11 <> 2)"
)
_CHANGED_SQL = (
    "c AS (SELECT * REPLACE (CASE WHEN o_orderkey % 2003 = 11 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, "
    "CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 1499 <> 7)"
)

_LATEST_LIVE = (
    "SELECT user_id, event_id, value FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rk "
    "FROM events) WHERE rk = 1 AND event_type <> 'error'"
)


def _oracle_sql() -> dict[str, str]:
    return {
        "high_water_mark": "SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') AS max_time_stamp FROM orders",
        "high_water_mark_seq": "SELECT coalesce(max(o_orderkey), 0) AS max_seq FROM orders",
        "extract_full": "SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'",
        "extract_full_unbounded": "SELECT * FROM customer",
        "extract_incremental": (
            "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2000-01-01' - INTERVAL 1 DAY "
            "AND TIMESTAMP '2001-01-01'"
        ),
        "extract_incremental_seq": "SELECT * FROM orders WHERE o_orderkey BETWEEN 1000 - 100 AND 1400",
        "number_rows": "SELECT o.*, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders o",
        "partition_bounds": (
            "SELECT min(o_orderkey) AS lower_bound, max(o_orderkey) AS upper_bound, count(*) AS row_count FROM orders"
        ),
        "csv_ingest": "SELECT r_regionkey, r_name FROM region",
        "empty_table": "SELECT *, 1 AS version FROM part",
        "latest_deleted_keys": (
            "SELECT user_id FROM (SELECT user_id, event_type, rank() OVER (PARTITION BY user_id ORDER BY event_id DESC) "
            "AS rk FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 1 DAY) WHERE rk = 1 AND event_type = 'error'"
        ),
        "stage_batch": (
            "SELECT o_orderkey, o_orderstatus, o_totalprice, false AS is_deleted FROM orders WHERE o_orderkey % 13 <> 0 "
            "UNION ALL SELECT o_orderkey, NULL, NULL, true FROM orders WHERE o_orderkey % 13 = 0"
        ),
        "conform_schema": (
            "SELECT CAST(p_partkey AS INTEGER) AS part_key, p_name AS part_name, "
            "CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price FROM part"
        ),
        "conform_rejects": (
            "SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END "
            "AS o_orderpriority FROM orders) WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL"
        ),
        "stage_count_check": "SELECT count(*) AS expected, count(*) AS actual, true AS ok FROM orders",
        "insert_keys": _TS + (
            "SELECT o_orderkey FROM S WHERE NOT is_deleted AND o_orderkey NOT IN (SELECT o_orderkey FROM T)"
        ),
        "delete_keys": _TS + "SELECT o_orderkey FROM S WHERE is_deleted AND o_orderkey IN (SELECT o_orderkey FROM T)",
        "changed_rows": _TS + (
            "SELECT s.o_orderkey FROM S s JOIN T t USING (o_orderkey) WHERE s.o_orderstatus IS DISTINCT FROM "
            "t.o_orderstatus OR s.o_totalprice IS DISTINCT FROM t.o_totalprice"
        ),
        "merge_incremental": _TS + (
            "SELECT * FROM T WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S) UNION ALL "
            "SELECT o_orderkey, o_orderstatus, o_totalprice FROM S WHERE NOT is_deleted"
        ),
        "merge_incremental_shuffle": _TS + (
            "SELECT * FROM T WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S) UNION ALL "
            "SELECT o_orderkey, o_orderstatus, o_totalprice FROM S WHERE NOT is_deleted"
        ),
        "merge_incremental_broadcast": _TS + (
            "SELECT * FROM T WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S) UNION ALL "
            "SELECT o_orderkey, o_orderstatus, o_totalprice FROM S WHERE NOT is_deleted"
        ),
        "merge_full": _TS + "SELECT o_orderkey, o_orderstatus, o_totalprice FROM S WHERE NOT is_deleted",
        "merge_expected_count": _TS + (
            "SELECT (SELECT count(*) FROM T) + (SELECT count(*) FROM S WHERE NOT is_deleted AND o_orderkey NOT IN "
            "(SELECT o_orderkey FROM T)) - (SELECT count(*) FROM S WHERE is_deleted AND o_orderkey IN "
            "(SELECT o_orderkey FROM T)) AS expected"
        ),
        "snapshot_restore": _TS
        + (
            "SELECT *, 2 AS version FROM T UNION ALL SELECT *, 1 AS version FROM T WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S) "
            "UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version FROM S WHERE NOT is_deleted"
        ),
        "pending_versions": (
            "SELECT *, CAST(year(o_orderdate) - 1995 AS INTEGER) AS version FROM orders "
            "WHERE year(o_orderdate) - 1995 > 1 AND year(o_orderdate) - 1995 <> 3"
        ),
        "change_log": _TS + (
            "SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'I' "
            "WHEN a.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS operation_type, b.o_totalprice AS old_price, "
            "a.o_totalprice AS new_price FROM T b FULL JOIN (SELECT * FROM S WHERE NOT is_deleted) a USING (o_orderkey) "
            "WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR b.o_orderstatus IS DISTINCT FROM a.o_orderstatus "
            "OR b.o_totalprice IS DISTINCT FROM a.o_totalprice"
        ),
        "change_log_versions": _TS + (
            ", M AS (SELECT * FROM T WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S) UNION ALL "
            "SELECT o_orderkey, o_orderstatus, o_totalprice FROM S WHERE NOT is_deleted) "
            "SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'I' "
            "WHEN a.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS operation_type, b.o_totalprice AS old_price, "
            "a.o_totalprice AS new_price FROM T b FULL JOIN M a USING (o_orderkey) "
            "WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR b.o_orderstatus IS DISTINCT FROM a.o_orderstatus "
            "OR b.o_totalprice IS DISTINCT FROM a.o_totalprice"
        ),
        "apply_change_log": _LATEST_LIVE,
        "check_primary_key": (
            "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"
        ),
        "check_not_null": (
            "SELECT count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey_nulls, "
            "count(*) FILTER (WHERE nullif(o_orderstatus,'P') IS NULL) AS o_orderstatus_nulls FROM orders"
        ),
        "check_foreign_key": (
            "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN "
            "(SELECT CASE WHEN c_custkey % 5 = 0 THEN -c_custkey - 1 ELSE c_custkey END FROM customer)"
        ),
        "history_scd2": (
            "SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) "
            "AS valid_to, lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM events"
        ),
        "history_scd2_deletes": (
            "SELECT user_id, event_type, valid_from, valid_to, is_current FROM (SELECT user_id, event_type, ts AS valid_from, "
            "lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, "
            "lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM events) WHERE event_type <> 'error'"
        ),
        "as_of": (
            "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) "
            "AS rn FROM events WHERE ts <= TIMESTAMP '2024-01-15') WHERE rn = 1"
        ),
        "stream_replay": _LATEST_LIVE,
        "stream_replay_bucketed": _LATEST_LIVE,
        "load_pipeline_recovered": "SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2001-08-01'",
        "merge_full_with_rejects": _TS
        + (
            "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 "
            "UNION ALL SELECT * FROM T WHERE o_orderkey >= 0 AND o_orderkey % 3 = 0"
        ),
        "load_pipeline": (
            "WITH v0 AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'), "
            "hwm AS (SELECT max(o_orderdate) AS h FROM v0), "
            "batch AS (SELECT o.* FROM orders o, hwm WHERE o.o_orderdate BETWEEN hwm.h - INTERVAL 1 DAY "
            "AND TIMESTAMP '2001-08-01'), "
            "live AS (SELECT * FROM batch WHERE o_orderkey % 13 <> 0), "
            "dels AS (SELECT o_orderkey FROM batch WHERE o_orderkey % 13 = 0) "
            "SELECT * FROM v0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM live) "
            "AND o_orderkey NOT IN (SELECT o_orderkey FROM dels) UNION ALL SELECT * FROM live"
        ),
        "load_pipeline_bucketed": (
            "WITH v0 AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'), "
            "hwm AS (SELECT max(o_orderdate) AS h FROM v0), "
            "batch AS (SELECT o.* FROM orders o, hwm WHERE o.o_orderdate BETWEEN hwm.h - INTERVAL 1 DAY "
            "AND TIMESTAMP '2001-08-01'), "
            "live AS (SELECT * FROM batch WHERE o_orderkey % 13 <> 0), "
            "dels AS (SELECT o_orderkey FROM batch WHERE o_orderkey % 13 = 0) "
            "SELECT * FROM v0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM live) "
            "AND o_orderkey NOT IN (SELECT o_orderkey FROM dels) UNION ALL SELECT * FROM live"
        ),
        "load_pipeline_range_bucketed": (
            "WITH v0 AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'), "
            "hwm AS (SELECT max(o_orderdate) AS h FROM v0), "
            "batch AS (SELECT o.* FROM orders o, hwm WHERE o.o_orderdate BETWEEN hwm.h - INTERVAL 1 DAY "
            "AND TIMESTAMP '2001-08-01'), "
            "live AS (SELECT * FROM batch WHERE o_orderkey % 13 <> 0), "
            "dels AS (SELECT o_orderkey FROM batch WHERE o_orderkey % 13 = 0) "
            "SELECT * FROM v0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM live) "
            "AND o_orderkey NOT IN (SELECT o_orderkey FROM dels) UNION ALL SELECT * FROM live"
        ),
        "history_from_batches": f"WITH {_RUNS_SQL}, "
        + (
            "every AS (SELECT * FROM st UNION ALL SELECT 3, o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 19 = 0 THEN o_totalprice * 2 ELSE o_totalprice END "
            "FROM st WHERE r = 2 AND o_orderkey % 17 <> 0), "
            "runs(r, run_at) AS (VALUES (0, TIMESTAMP '1998-01-01'), (1, TIMESTAMP '2000-01-01'), (2, TIMESTAMP '2001-08-01'), (3, TIMESTAMP '2001-09-01')), "
            "g AS (SELECT k.o_orderkey, runs.r, run_at, e.o_orderstatus, e.o_totalprice, e.r IS NOT NULL AS here FROM (SELECT DISTINCT o_orderkey FROM every) k "
            "CROSS JOIN runs LEFT JOIN every e ON e.o_orderkey = k.o_orderkey AND e.r = runs.r), "
            "l AS (SELECT *, coalesce(lag(here) OVER w, false) AS was, lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus "
            "OR lag(o_totalprice) OVER w IS DISTINCT FROM o_totalprice AS differs FROM g WINDOW w AS (PARTITION BY o_orderkey ORDER BY r)), "
            "c AS (SELECT *, here AND (NOT was OR differs) AS opens FROM l WHERE (here AND (NOT was OR differs)) OR (was AND NOT here)) "
            "SELECT o_orderkey, o_orderstatus, o_totalprice, run_at AS valid_from, nxt AS valid_to, nxt IS NULL AS is_current FROM "
            "(SELECT *, lead(run_at) OVER (PARTITION BY o_orderkey ORDER BY r) AS nxt FROM c) WHERE opens"
        ),
        "history_late": (
            "SELECT user_id, event_type, valid_from, valid_to, is_current FROM (SELECT user_id, event_type, ts AS valid_from, "
            "lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, "
            "lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) IS NULL AS is_current FROM events) WHERE event_type <> 'error'"
        ),
        "audit_gaps": (
            "SELECT event_id + 1 AS lo, nxt - 1 AS hi FROM (SELECT event_id, lead(event_id) OVER (ORDER BY event_id) AS nxt FROM events "
            "WHERE event_id % 97 <> 0 AND NOT event_id % 1009 BETWEEN 500 AND 520) WHERE nxt > event_id + 1"
        ),
        "asof_join": (
            "WITH h AS (SELECT user_id, event_id AS state_id, event_type AS state, value AS state_value, ts AS valid_from, "
            "lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to FROM events WHERE event_type <> 'purchase'), "
            "s AS (SELECT * FROM h WHERE state <> 'error') "
            "SELECT p.event_id, p.user_id, p.ts, CASE WHEN valid_to IS NULL OR valid_to > ts THEN state_id END AS state_id, "
            "CASE WHEN valid_to IS NULL OR valid_to > ts THEN state END AS state, CASE WHEN valid_to IS NULL OR valid_to > ts THEN state_value END AS state_value "
            "FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN s ON p.user_id = s.user_id AND p.ts >= s.valid_from"
        ),
        "reconcile_ranges": f"WITH {_CHANGED_SQL}, "
        + (
            "d AS ((SELECT * FROM orders EXCEPT ALL SELECT * FROM c) UNION ALL (SELECT * FROM c EXCEPT ALL SELECT * FROM orders)), "
            "leaves AS (SELECT DISTINCT CAST(floor(o_orderkey / 64.0) AS BIGINT) AS leaf FROM d) "
            "SELECT leaf * 64 AS lower, (leaf + 1) * 64 AS upper, (SELECT count(*) FROM orders o WHERE floor(o.o_orderkey / 64.0) = leaf) AS rows_before, "
            "(SELECT count(*) FROM c WHERE floor(c.o_orderkey / 64.0) = leaf) AS rows_after FROM leaves"
        ),
        "reconcile_rows": f"WITH {_CHANGED_SQL} "
        + (
            "SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'I' WHEN c.o_orderkey IS NULL THEN 'D' "
            "ELSE 'U' END AS operation_type FROM orders o FULL JOIN c ON o.o_orderkey = c.o_orderkey "
            "WHERE o.o_orderkey IS NULL OR c.o_orderkey IS NULL OR o.o_totalprice <> c.o_totalprice"
        ),
        "merge_incremental_bloom": _TS + (
            "SELECT * FROM T WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S) UNION ALL "
            "SELECT o_orderkey, o_orderstatus, o_totalprice FROM S WHERE NOT is_deleted"
        ),
        "compact_log": (
            "WITH e AS (SELECT user_id, event_id, value, CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op, "
            "row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS f, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS l, "
            "count(*) OVER (PARTITION BY user_id) AS n_ops FROM events), "
            "n AS (SELECT b.user_id, l.value, CASE WHEN l.op = 'D' THEN CASE WHEN b.op <> 'I' THEN 'D' END WHEN b.op = 'I' THEN 'I' ELSE 'U' END AS operation_type, "
            "l.event_id, b.event_id AS first_seq, b.op AS first_op, b.n_ops FROM e b JOIN e l ON b.user_id = l.user_id AND b.f = 1 AND l.l = 1) "
            "SELECT * FROM n WHERE operation_type IS NOT NULL"
        ),
        "bitemporal_as_of": (
            "WITH points(point, v, k) AS (VALUES (0, TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-08'), (1, TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-29'), "
            "(2, TIMESTAMP '2024-01-14', TIMESTAMP '2024-01-22'), (3, TIMESTAMP '2024-01-25', TIMESTAMP '2024-01-29')), "
            "known AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 7 DAYS ELSE ts END AS arrives FROM events) "
            "SELECT user_id, event_id, value, point FROM (SELECT user_id, event_id, value, event_type, point, rank() OVER (PARTITION BY point, user_id ORDER BY ts DESC) AS rk "
            "FROM points JOIN known ON arrives <= k AND ts <= v) WHERE rk = 1 AND event_type <> 'error'"
        ),
        "stream_replay_state": _LATEST_LIVE,
        "stream_replay_backfill": _LATEST_LIVE,
        "balanced_ranges": "SELECT count(*) AS total, 0 AS wrong, 0 AS too_large FROM lineitem",
        "load_parallel": "SELECT o_orderkey, o_custkey, c_nationkey, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey",
    }
