import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators import changes, history
from lakeloom.operators.merge import merge

AUDIT = "k long, audit_id long, operation_type string, operation_timestamp timestamp_ntz, v string"
D = dt.datetime


def keys(df):
    return sorted(r[0] for r in df.collect())


def test_latest_deleted_keys_edge_cases(spark):
    log = spark.createDataFrame(
        [
            (1, 5, "D", D(2025, 1, 10), None),  # deleted then re-inserted
            (1, 6, "I", D(2025, 1, 10), "a"),
            (2, 7, "D", D(2025, 1, 10), None),  # long-unchanged row deleted inside the window
            (3, 1, "U", D(2025, 1, 1), "b"),  # outside the window
            (3, 2, "D", D(2024, 12, 1), None),  # delete before the window: not seen
            (4, 8, "U", D(2025, 1, 10), "c"),
            (4, 9, "D", D(2025, 1, 11), None),
        ],
        AUDIT,
    )
    got = changes.latest_deleted_keys(
        log, ["k"], "audit_id", time_col="operation_timestamp", since=D(2025, 1, 9), until=D(2025, 1, 31)
    )
    assert keys(got) == [2, 4]


def test_change_log_round_trip(spark):
    before = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "k long, s string, x double")
    after = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0)], "k long, s string, x double")
    log = changes.change_log(before, after, ["k"])
    ops = {r["k"]: r["operation_type"] for r in log.collect()}
    assert ops == {2: "U", 3: "D", 4: "I"}
    # apply(before, change_log(before, after)) == after
    parsed = changes.parse_payload(log, "new_data", before.schema)
    batch = parsed.select(
        "k",
        F.col("new_data.s").alias("s"),
        F.col("new_data.x").alias("x"),
        (F.col("operation_type") == "D").alias("is_deleted"),
    )
    applied = merge(before, batch, ["k"], "incremental", strategy="full_outer")
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, after.collect()))


def _reference_lead(df):
    w = Window.partitionBy("k").orderBy("seq")
    return sorted(
        (r["k"], r["seq"], r["nx"])
        for r in df.select("k", "seq", F.lead("ts").over(w).alias("nx")).collect()
    )


def test_scd2_bucketed_matches_plain_window_with_hot_key(spark):
    # key 0 holds a third of the rows; small buckets force many group boundaries
    data = []
    for i in range(600):
        k = 0 if i % 3 == 0 else (i % 17) + 1
        data.append((k, i * 3 + (i % 2), D(2024, 1, 1) + dt.timedelta(minutes=i)))
    df = spark.createDataFrame(data, "k long, seq long, ts timestamp_ntz")
    for width in (1, 7, 50, 1 << 20):
        out = history.scd2(df, ["k"], "seq", "ts", cols=["seq", "ts"], bucket_width=width)
        got = sorted((r["k"], r["seq"], r["valid_to"]) for r in out.collect())
        assert got == _reference_lead(df), width
        cur = out.where("is_current").groupBy("k").count().collect()
        assert all(r["count"] == 1 for r in cur)


def test_scd2_negative_sequences(spark):
    df = spark.createDataFrame([(1, -5, D(2024, 1, 1)), (1, -1, D(2024, 1, 2)), (1, 3, D(2024, 1, 3))], "k long, seq long, ts timestamp_ntz")
    out = history.scd2(df, ["k"], "seq", "ts", cols=["seq", "ts"], bucket_width=2)
    got = sorted((r["seq"], r["valid_to"]) for r in out.collect())
    assert got == [(-5, D(2024, 1, 2)), (-1, D(2024, 1, 3)), (3, None)]


def test_as_of(spark):
    df = spark.createDataFrame(
        [(1, 1, D(2024, 1, 1)), (1, 2, D(2024, 1, 5)), (2, 3, D(2024, 1, 6))], "k long, seq long, ts timestamp_ntz"
    )
    got = sorted(map(tuple, history.as_of(df, ["k"], "seq", "ts", D(2024, 1, 5)).collect()))
    assert got == [(1, 2)]


def test_snapshot_changes_reads_only_changed_buckets(spark):
    from lakeloom.plans.workspace import work_dir
    from lakeloom.sources.snapshots import SnapshotTable

    t = SnapshotTable(spark, work_dir(spark, "snapchanges"), ("k",), 32)
    base = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    t.write(base)
    batch = spark.createDataFrame([(3, 0, False), (7, None, True), (1000, 1, False)], "k long, v long, is_deleted boolean")
    touched = sorted(r["b"] for r in batch.select(F.pmod(F.hash("k"), F.lit(32)).alias("b")).distinct().collect())
    merged = merge(t.read(buckets=touched), batch, ["k"], "incremental", strategy="full_outer")
    t.write(merged, replace_buckets=touched)
    assert t.changed_buckets(0, 1) == touched
    got = changes.snapshot_changes(t, 0, 1, ["k"])
    full = changes.change_log(t.read(0), t.read(1), ["k"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    assert sorted((r.k, r.operation_type) for r in got.collect()) == [(3, "U"), (7, "D"), (1000, "I")]
    assert t.read(as_of=dt.datetime(2100, 1, 1)).count() == 500  # latest
    assert t.version_as_of(dt.datetime.fromisoformat(t.commit(0).written_at)) == 0


def test_scd2_spreads_a_hot_key_over_tasks(spark):
    data = [(0 if i % 3 else i % 50 + 1, i, D(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, seq long, ts timestamp_ntz")  # key 0 holds two thirds of the rows
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = history.scd2(df, ["k"], "seq", "ts", cols=["seq", "ts"], bucket_width=64)
        # aggregate a window output column too, so pruning cannot drop the window
        per_task = [F.count(F.lit(1)).alias("n"), F.max("valid_to").alias("m")]
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(*per_task).collect()]
        plain = df.withColumn("valid_to", F.lead("ts").over(Window.partitionBy("k").orderBy("seq")))
        plain_sizes = [r["n"] for r in plain.groupBy(F.spark_partition_id()).agg(*per_task).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert max(plain_sizes) >= 2000  # a plain key window puts the hot key in one task
    assert max(sizes) < 0.4 * 3000  # the bucketed window spreads it
