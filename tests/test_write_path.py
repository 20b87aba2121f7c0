"""How merges write: one task a bucket, keys checked there, no work files left."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.checks import CheckFailed
from lakeloom.operators.numbering import number_rows
from lakeloom.plans import pipeline
from lakeloom.plans.control import ControlTable
from lakeloom.plans.workspace import checkpoint_dir, list_dirs, list_files, path_exists, work_dir
from lakeloom.sources.snapshots import SnapshotTable
from lakeloom.spec import LoadMode, TableSpec

AT = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("replace", [None, [1, 4, 6]])
def test_every_bucket_has_a_task_of_its_own(spark, replace):
    table = SnapshotTable(spark, work_dir(spark, "tasks"), ["k"], 8)
    rows = spark.range(4000).select(F.col("id").alias("k"))
    table.write(rows)
    if replace:
        rows = rows.where(table.bucket_expr().isin(replace))
    seen = {}

    def finish(df):
        nonlocal seen
        placed = df.groupBy("_bucket", F.spark_partition_id().alias("task")).count().collect()
        seen = {(r["_bucket"], r["task"]) for r in placed}
        return df

    table.stage_write(rows, replace_buckets=replace, finish=finish)
    buckets = replace or list(range(8))
    # As many tasks as buckets, each with one.
    assert len(seen) == len(buckets) == len({t for _, t in seen})


@pytest.mark.parametrize("buckets", [0, 8])
def test_a_key_stored_twice_is_not_served(spark, buckets, monkeypatch):
    """Also when the batch's own check did not see it."""
    base = work_dir(spark, "twice")
    stg, cur = SnapshotTable(spark, f"{base}/staging"), SnapshotTable(spark, f"{base}/current", ["k"] if buckets else None, buckets)
    control = ControlTable(spark, f"{base}/_control")
    spec = TableSpec("t", ("k",), LoadMode.FULL)
    pipeline.stage_table(spark, spec, spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "k long, v long"), None, stg, control, AT)
    monkeypatch.setattr(pipeline, "combined_batch", lambda staging, commits, *a: pipeline.batch_from_staging(staging, commits[-1].version))
    with pytest.raises(CheckFailed):
        pipeline.merge_table(spark, spec, stg, cur, control, AT)
    assert not cur.exists()


def test_bucketed_merge_reads_nothing_back_for_the_key_check(spark, monkeypatch):
    base = work_dir(spark, "once")
    stg, cur = SnapshotTable(spark, f"{base}/staging"), SnapshotTable(spark, f"{base}/current", ["k"], 8)
    control = ControlTable(spark, f"{base}/_control")
    checked = []
    real = pipeline.require_keys_valid
    monkeypatch.setattr(pipeline, "require_keys_valid", lambda df, keys, what="batch", sample=5: (checked.append(what), real(df, keys, what, sample)))
    full = TableSpec("t", ("k",), LoadMode.FULL)
    incr = TableSpec("t", ("k",), LoadMode.INCREMENTAL, update_col="u", overlap=0)
    for spec, rows in ((full, [(k, k) for k in range(50)]), (incr, [(k, 100 + k) for k in range(45, 60)])):
        pipeline.stage_table(spark, spec, spark.createDataFrame(rows, "k long, u long"), None, stg, control, AT)
        pipeline.merge_table(spark, spec, stg, cur, control, AT)
    assert checked == ["t batch", "t batch"]
    assert cur.read().columns == ["k", "u"]
    assert sorted(map(tuple, cur.read().collect())) == [(k, k) for k in range(45)] + [(k, 100 + k) for k in range(45, 60)]


def test_row_numbers_leave_no_files(spark):
    folders = []
    rows = spark.range(100).select((99 - F.col("id")).alias("k"))
    got = number_rows(rows, ["k"], num_partitions=5, folders=folders)
    assert sorted(map(tuple, got.collect())) == [(k, k + 1) for k in range(100)]
    assert len(folders) == 1 and len([f for f in list_files(spark, folders[0]) if f.endswith(".parquet")]) == 5
    assert number_rows(rows.limit(0), ["k"]).collect() == []

    base = work_dir(spark, "numbered-stage")
    schema = T.StructType([T.StructField("row_number", T.LongType()), T.StructField("k", T.LongType())])
    spec = TableSpec("t", ("k",), LoadMode.FULL, staging_schema=schema)
    work = f"{checkpoint_dir(spark)}/lakeloom"
    numbered = lambda: {d for d in list_dirs(spark, work) if d.startswith("numbered-") and "stage" not in d}
    before = numbered()
    stg = SnapshotTable(spark, f"{base}/staging")
    pipeline.stage_table(spark, spec, rows, None, stg, ControlTable(spark, f"{base}/_control"), AT)
    assert numbered() == before
    assert sorted(r["row_number"] for r in stg.read().collect()) == list(range(1, 101))
    assert path_exists(spark, folders[0])  # the caller's to delete


def test_large_tables_are_bucketed_unless_told_otherwise(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "BUCKETED_FROM", 500)
    monkeypatch.setattr(pipeline, "buckets_for", lambda size: 4)
    specs = [TableSpec("large", ("k",), LoadMode.INCREMENTAL, update_col="u", overlap=0), TableSpec("small", ("k",), LoadMode.FULL)]
    source = lambda n: {"large": spark.createDataFrame([(k, k) for k in range(n)], "k long, u long"), "small": spark.createDataFrame([(1, 1)], "k long, u long")}
    root = work_dir(spark, "auto")
    pipeline.run_tables(spark, specs, source(100), {}, root, AT)
    layout = pipeline.Layout(root)
    assert layout.current(spark, specs[0]).layout == {"keys": ["k"], "buckets": 4, "width": None}
    assert layout.current(spark, specs[1]).layout is None
    # Later loads keep the layout, whatever the sizes are then; another layout can still be asked for.
    monkeypatch.setattr(pipeline, "BUCKETED_FROM", 1 << 40)
    pipeline.run_tables(spark, specs, source(103), {}, root, AT)
    table = layout.current(spark, specs[0])
    assert table.bucketed and table.read().count() == 103
    untouched = [v for v in table.current().manifest.values() if v[0] == 0]
    assert untouched  # three new keys did not rewrite every bucket
    assert not pipeline.Layout(root, buckets=0).current(spark, specs[0]).bucketed


def test_content_that_differs_at_equal_counts_is_found(spark):
    base = work_dir(spark, "content")
    cur = SnapshotTable(spark, f"{base}/current")
    rows = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("int").alias("v"))
    cur.write(rows)
    spec = TableSpec("t", ("k",), LoadMode.FULL)
    assert pipeline.reconcile_content(spec, rows.withColumn("more", F.lit(1)), cur, ranges=100).count() == 0
    changed = rows.withColumn("v", F.when(F.col("k") == 1234, -1).otherwise(F.col("v")).cast("long"))
    assert [tuple(r) for r in pipeline.reconcile_content(spec, changed, cur, ranges=100).collect()] == [(1200, 1250, 50, 50)]
    text_key = TableSpec("t", ("s",), LoadMode.FULL)
    named = SnapshotTable(spark, f"{base}/named")
    named.write(rows.select(F.col("k").cast("string").alias("s"), "v"))
    found = pipeline.reconcile_content(text_key, changed.select(F.col("k").cast("string").alias("s"), "v"), named, ranges=100)
    assert found.count() == 1
