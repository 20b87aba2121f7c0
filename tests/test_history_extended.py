"""As-of joins, sequences, history from batches, bitemporal history: edge cases, hot keys, properties."""

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators import asof, bitemporal, sequences
from lakeloom.operators.batch_history import history_from_batches
from lakeloom.operators.checks import CheckFailed
from lakeloom.plans import pipeline
from lakeloom.plans.control import ControlTable
from lakeloom.plans.workspace import empty_frame, work_dir
from lakeloom.sources.snapshots import SnapshotTable
from lakeloom.spec import LoadMode, TableSpec

# --- as-of join


def plain_asof(facts, versions):
    """facts (id, key, time), versions (key, time, seq, value)."""
    out = []
    for i, k, t in facts:
        best = max((v for v in versions if v[0] == k and v[1] is not None and t is not None and v[1] <= t), key=lambda v: (v[1], v[2]), default=None)
        out.append((i, k, t, best[3] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,group_rows", [(1, 5), (7, 1000), (1 << 20, 3)])
def test_asof_join_is_the_plain_search(spark, width, group_rows):
    rng = random.Random(width)
    keys = [0] * 30 + [1, 2, 3, None]  # one key has most rows
    facts = [(i, rng.choice(keys), rng.choice([None, *range(-30, 90)])) for i in range(400)]
    versions = [(rng.choice(keys), rng.choice([None, *range(-20, 80, 3)]), s, s * 10) for s in range(120)]
    f = spark.createDataFrame(facts, "id long, k long, t long")
    v = spark.createDataFrame(versions, "k long, vt long, s long, value long")
    got = asof.asof_join(f, v, ["k"], "t", "vt", ["value"], version_seq="s", bucket_width=width, group_rows=group_rows)
    assert got.columns == ["id", "k", "t", "value"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_asof(facts, versions)
    inner = asof.asof_join(f, v, ["k"], "t", "vt", ["value"], version_seq="s", how="inner", bucket_width=width)
    assert sorted(map(tuple, inner.collect()), key=str) == [r for r in plain_asof(facts, versions) if r[3] is not None]


def test_asof_join_times_and_ended_versions(spark):
    f = spark.createDataFrame([(1, "2024-01-01 12:00:00"), (2, "2024-03-01 00:00:00"), (3, "1950-01-01 00:00:00")], "id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    v = spark.createDataFrame([("a", "2024-01-01 12:00:00", "2024-02-01 00:00:00")], "name string, vf string, vt string").select("name", F.col("vf").cast("timestamp_ntz").alias("vf"), F.col("vt").cast("timestamp_ntz").alias("vt"))
    got = asof.asof_join(f, v, [], "t", "vf", ["name"], valid_to="vt")
    assert {r["id"]: r["name"] for r in got.collect()} == {1: "a", 2: None, 3: None}
    with pytest.raises(ValueError):
        asof.asof_join(f, v, [], "t", "name", ["vt"])
    with pytest.raises(ValueError):
        asof.asof_join(f, v.withColumnRenamed("name", "id"), [], "t", "vf", ["id"])


def test_asof_join_spreads_a_hot_key(spark):
    """A third of all facts have one key at one time: no task sees more than a few groups of them."""
    n = 30_000
    f = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("k"), F.lit(5).cast("long").alias("t"))
    v = spark.createDataFrame([(0, 1, 7)], "k long, vt long, value long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = asof.asof_join(f, v, ["k"], "t", "vt", ["value"], group_rows=250)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert got.where("value = 7").count() == n // 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == n


def test_asof_join_plan_has_no_range_join(spark):
    f = spark.range(10).select("id", F.col("id").alias("t"))
    v = spark.range(10).select(F.col("id").alias("vt"), F.col("id").alias("value"))
    plan = asof.asof_join(f, v, [], "t", "vt", ["value"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- sequences


def plain_gaps(numbers):
    seen = sorted({n for n in numbers if n is not None})
    return [(a + 1, b - 1) for a, b in zip(seen, seen[1:]) if b > a + 1]


def plain_islands(numbers):
    out = []
    for n in sorted({n for n in numbers if n is not None}):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("width", [4, 64, 1 << 20])
def test_gaps_islands_and_merged_intervals(spark, width):
    rng = random.Random(width)
    for numbers in ([], [5], [5, 5, None], [-7, -6, 0, 1, 100, 300, 301], [rng.randrange(-50, 400) for _ in range(200)], [n for n in range(300) if n % 41]):
        log = spark.createDataFrame([(n,) for n in numbers], "s long")
        assert sorted(map(tuple, sequences.gaps(log, "s", width).collect())) == plain_gaps(numbers)
        assert sorted(map(tuple, sequences.islands(log, "s", width).collect())) == plain_islands(numbers)
    spans = [(lo, lo + rng.randrange(0, 12)) for lo in rng.sample(range(-40, 400), 60)] + [(10, 10), (11, 11), (3, 2)]
    got = sequences.merge_intervals(spark.createDataFrame(spans, sequences.INTERVAL), width).collect()
    assert sorted(map(tuple, got)) == plain_islands([n for lo, hi in spans for n in range(lo, hi + 1)])


def test_unconsumed_entries(spark):
    log = spark.createDataFrame([(i, "x") for i in range(20)], "s int, x string")
    consumed = spark.createDataFrame([(0, 4), (6, 9), (12, 12)], sequences.INTERVAL)
    got = sequences.unconsumed(log, "s", consumed, 4)
    assert got.columns == ["s", "x"]
    assert sorted(r["s"] for r in got.collect()) == [5, 10, 11, *range(13, 20)]


# --- history from an audit log that shows entries late


def intervals(df):
    return sorted(map(tuple, df.select("k", "v", "valid_from", "valid_to", "is_current").collect()), key=str)


@pytest.mark.parametrize("buckets", [0, 8])
def test_late_audit_entries_enter_the_history(spark, buckets):
    rng = random.Random(buckets)
    rows = [(s, rng.choice([0, 0, 0, 1, 2, None]), rng.choice("IUUD"), s, dt.datetime(2024, 1, 1) + dt.timedelta(hours=s)) for s in range(60)]
    schema = "seq long, k long, operation_type string, v long, operation_timestamp timestamp_ntz"
    spec = TableSpec("t", ("k",), audit_seq_col="seq", point_in_time=True)
    table = SnapshotTable(spark, work_dir(spark, "late-history"), ["k"] if buckets else None, buckets)
    order = rows[:]
    rng.shuffle(order)
    for visible in (20, 21, 45, 60, 60):
        audit = spark.createDataFrame(order[:visible], schema)
        commit = pipeline.build_history(spec, audit, table)
        whole = SnapshotTable(spark, work_dir(spark, "whole-history"))
        pipeline.build_history(spec, audit, whole)
        assert intervals(table.read()) == intervals(whole.read())
    assert pipeline.build_history(spec, audit, table) == commit  # nothing new, nothing written


def test_audit_entry_without_sequence_is_refused(spark):
    spec = TableSpec("t", ("k",), audit_seq_col="seq", point_in_time=True)
    audit = spark.createDataFrame([(None, 1, "I", dt.datetime(2024, 1, 1))], "seq long, k long, operation_type string, operation_timestamp timestamp_ntz")
    with pytest.raises(CheckFailed):
        pipeline.build_history(spec, audit, SnapshotTable(spark, work_dir(spark, "no-seq")))


# --- history from staged batches


def plain_batches(batches):
    """Intervals (k, v, from, to, current) of ``(rows, at, full)``; rows (k, v, deleted)."""
    state, out = {}, []
    for rows, at, full in batches:
        after = {} if full else {k: v for k, (v, _) in state.items()}
        for k, v, gone in rows:
            if gone:
                after.pop(k, None)
            else:
                after[k] = v
        for k in list(state):
            if k not in after or after[k] != state[k][0]:
                v, since = state.pop(k)
                out.append((k, v, since, at, False))
        for k, v in after.items():
            state.setdefault(k, (v, at))
    return sorted(out + [(k, v, since, None, True) for k, (v, since) in state.items()], key=str)


def random_batches(seed):
    rng, out = random.Random(seed), []
    for day in range(1, 8):
        full = rng.random() < 0.4
        rows = [(k, rng.choice([None, 1, 2]), not full and rng.random() < 0.3) for k in range(12) if rng.random() < 0.6]
        out.append((rows, dt.datetime(2024, 1, day), full))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_history_from_batches_is_the_plain_fold(spark, seed):
    batches = random_batches(seed)
    frames = [(spark.createDataFrame(rows, "k long, v long, is_deleted boolean"), at, full) for rows, at, full in batches]
    assert intervals(history_from_batches(frames, ["k"])) == plain_batches(batches)


@pytest.mark.parametrize("buckets", [0, 4])
def test_point_in_time_layer_without_an_audit_log(spark, buckets):
    """The merge job builds it from what is staged; keys whose rows are rejected keep their intervals."""
    root = work_dir(spark, "pit")
    spec = TableSpec("sales", ("k",), LoadMode.FULL, point_in_time=True, staging_schema=T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.IntegerType())]))
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    loads = [[(1, "10"), (2, "20"), (3, "30")], [(1, "11"), (2, "bad"), (4, "40")], [(1, "11"), (2, "22"), (4, "41")]]
    for at, rows in zip(days, loads):
        pipeline.run_tables(spark, [spec], {"sales": spark.createDataFrame(rows, "k long, v string")}, {}, root, at, buckets=buckets)
    got = intervals(pipeline.Layout(root, buckets).history(spark, spec).read())
    a, b, c = days
    assert got == sorted([(1, 10, a, b, False), (1, 11, b, None, True), (2, 20, a, c, False), (2, 22, c, None, True), (3, 30, a, b, False), (4, 40, b, c, False), (4, 41, c, None, True)], key=str)


def test_a_pending_full_load_stays_full_when_the_spec_changes(spark):
    base = work_dir(spark, "mode-change")
    stg, cur = SnapshotTable(spark, f"{base}/staging"), SnapshotTable(spark, f"{base}/current")
    control = ControlTable(spark, f"{base}/_control")
    full = TableSpec("t", ("k",), LoadMode.FULL)
    frame = lambda rows: spark.createDataFrame(rows, "k long, u long")
    pipeline.stage_table(spark, full, frame([(1, 1), (2, 2)]), None, stg, control, dt.datetime(2024, 1, 1))
    pipeline.merge_table(spark, full, stg, cur, control, dt.datetime(2024, 1, 1))
    pipeline.stage_table(spark, full, frame([(2, 2), (3, 3)]), None, stg, control, dt.datetime(2024, 1, 2))
    incr = TableSpec("t", ("k",), LoadMode.INCREMENTAL, update_col="u", overlap=0)
    pipeline.stage_table(spark, incr, frame([(9, 9)]), None, stg, control, dt.datetime(2024, 1, 3))
    pipeline.merge_table(spark, incr, stg, cur, control, dt.datetime(2024, 1, 3))
    assert sorted(r["k"] for r in cur.read().collect()) == [2, 3, 9]


# --- bitemporal history


def test_bitemporal_state_at_every_pair_of_times(spark):
    """Random loads with corrections, deletes and repeated statements against a plain model."""
    rng = random.Random(7)
    payload = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    held = empty_frame(spark, bitemporal.bitemporal_schema(payload, T.LongType(), T.LongType()))
    loads = {}
    for at in (10, 20, 30):
        rows = [(rng.choice([0, 0, 0, 1, None]), rng.randrange(0, 40, 3), s, rng.choice([1, 2, 3]), rng.choice("UUUD")) for s in range(14)]
        loads[at] = rows
        said = bitemporal.statements(spark.createDataFrame(rows, "k long, t long, s long, v long, operation_type string"), ["k"], "t", "s", ["v"], op_col="operation_type")
        parts = bitemporal.apply_load(held, said, ["k"], at, bucket_width=6)
        held = parts[0].unionByName(parts[1]).checkpoint()

    def plain(valid, known):
        timeline = {}
        for at, rows in loads.items():
            if at <= known:
                newest = {}
                for k, t, s, v, op in rows:
                    if (k, t) not in newest or newest[k, t][0] < s:
                        newest[k, t] = (s, v, op)
                timeline.update({kt: (v, op) for kt, (s, v, op) in newest.items()})
        out = []
        for k in {k for k, _ in timeline}:
            best = max((t for kk, t in timeline if kk == k and t <= valid), default=None)
            if best is not None and timeline[k, best][1] != "D":
                out.append((k, timeline[k, best][0]))
        return sorted(out, key=str)

    times = [(valid, known) for known in (5, 10, 15, 20, 30, 99) for valid in (-1, 0, 7, 12, 39, 50)]
    states = reduce(DataFrame.unionByName, [bitemporal.as_of(held, v, k).select(F.lit(v).alias("valid"), F.lit(k).alias("known"), "k", "v") for v, k in times])
    got = [tuple(r) for r in states.collect()]
    for v, k in times:
        assert sorted([r[2:] for r in got if r[:2] == (v, k)], key=str) == plain(v, k), (v, k)
    # Open rectangles of a key do not overlap, and a load that says nothing new changes nothing.
    again = bitemporal.apply_load(held, bitemporal.statements(spark.createDataFrame(loads[30], "k long, t long, s long, v long, operation_type string"), ["k"], "t", "s", ["v"], op_col="operation_type"), ["k"], 40)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(again[0].unionByName(again[1])) == rows(held)
