import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.checks import CheckFailed
from lakeloom.plans import control as ctl
from lakeloom.plans import pipeline
from lakeloom.plans.workspace import work_dir
from lakeloom.sources.snapshots import SnapshotTable
from lakeloom.spec import LoadMode, TableSpec, load_specs

D = dt.datetime
Dec = decimal.Decimal

# Staging schema of a product dimension (business columns, declared types).
PRODUCT = T.StructType(
    [
        T.StructField("product_key", T.IntegerType(), False),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("unit_price", T.DecimalType(10, 2), True),
        T.StructField("last_updt_col", T.TimestampNTZType(), False),
    ]
)
SRC = "product_key int, product_id string, product_name string, category string, brand string, unit_price string, last_updt_col timestamp_ntz"
AUDIT = "product_key int, audit_id long, operation_type string, operation_timestamp timestamp_ntz"


def spec(**kw):
    base = dict(
        name="dim_product",
        keys=("product_key",),
        load_mode=LoadMode.INCREMENTAL,
        update_col="last_updt_col",
        audit_seq_col="audit_id",
        staging_schema=PRODUCT,
    )
    base.update(kw)
    return TableSpec(**base)


def tables(spark, name):
    base = work_dir(spark, name)
    return (
        SnapshotTable(spark, f"{base}/staging"),
        SnapshotTable(spark, f"{base}/current"),
        ctl.ControlTable(spark, f"{base}/_control"),
    )


def seed(spark):
    return spark.createDataFrame(
        [
            (1, "P1", "watch", "tech", "acme", "10.50", D(2025, 1, 1, 9)),
            (2, "P2", "beans", "food", None, "3.25", D(2025, 1, 1, 9)),
            (3, "P3", "shirt", "wear", "sty", "7.00", D(2025, 1, 1, 9)),
        ],
        SRC,
    )


def current_rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_incremental_pipeline_with_deletes_and_rejects(spark):
    stg, cur, control = tables(spark, "pipe_incr")
    s = spec()
    r1 = pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    assert (r1.rows, r1.tombstones, r1.rejects) == (3, 0, 0)
    assert r1.high_water_mark == D(2025, 1, 1, 9)
    m1 = pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    assert m1.check.ok and m1.actions["insert"] == 3

    # six days later: two new rows, one bad price, one price change, product 2 deleted
    batch = spark.createDataFrame(
        [
            (1, "P1", "watch", "tech", "acme", "9.99", D(2025, 1, 7, 10)),
            (4, "P4", "mug", "home", "acme", "4.00", D(2025, 1, 7, 10)),
            (5, "P5", "lamp", "home", None, "not a price", D(2025, 1, 7, 10)),
            (6, "P6", "old", "home", None, "1.00", D(2024, 12, 1)),  # below the window: not extracted
        ],
        SRC,
    )
    audit = spark.createDataFrame(
        [(2, 10, "U", D(2025, 1, 5)), (2, 11, "D", D(2025, 1, 6)), (3, 12, "D", D(2025, 1, 6)), (3, 13, "I", D(2025, 1, 6))],
        AUDIT,
    )
    r2 = pipeline.stage_table(spark, s, batch, audit, stg, control, D(2025, 1, 8))
    assert (r2.rows, r2.tombstones, r2.rejects) == (4, 1, 1)
    m2 = pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 8))
    assert m2.strategy == "broadcast"
    assert {k: m2.actions[k] for k in ("insert", "update", "delete", "keep")} == {"insert": 1, "update": 1, "delete": 1, "keep": 1}
    assert current_rows(cur) == [
        (1, "P1", "watch", "tech", "acme", Dec("9.99"), D(2025, 1, 7, 10)),
        (3, "P3", "shirt", "wear", "sty", Dec("7.00"), D(2025, 1, 1, 9)),
        (4, "P4", "mug", "home", "acme", Dec("4.00"), D(2025, 1, 7, 10)),
    ]
    rejects = stg.read().where(F.col("_reject").isNotNull()).collect()
    assert [(r.product_key, r._reject) for r in rejects] == [(5, "unit_price")]
    row = control.row("dim_product")
    assert row.last_version_run == 1 and row.high_water_mark == "2025-01-07 10:00:00"


def test_empty_and_delete_only_batches_keep_the_mark(spark):
    stg, cur, control = tables(spark, "pipe_empty")
    s = spec()
    pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    empty = spark.createDataFrame([], SRC)
    r = pipeline.stage_table(spark, s, empty, None, stg, control, D(2025, 1, 3))
    assert r.rows == 0 and r.high_water_mark == D(2025, 1, 1, 9)
    audit = spark.createDataFrame([(1, 20, "D", D(2025, 1, 3))], AUDIT)
    r = pipeline.stage_table(spark, s, empty, audit, stg, control, D(2025, 1, 4))
    assert (r.rows, r.tombstones) == (1, 1)
    assert r.high_water_mark == D(2025, 1, 1, 9)
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 4))
    assert [x[0] for x in current_rows(cur)] == [2, 3]


def test_boundaries_are_inclusive(spark):
    stg, cur, control = tables(spark, "pipe_bounds")
    s = spec(audit_seq_col=None)
    pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    hwm = D(2025, 1, 1, 9)
    src = spark.createDataFrame(
        [
            (7, "P7", "a", "c", None, "1.00", hwm - dt.timedelta(days=1)),
            (8, "P8", "b", "c", None, "1.00", D(2025, 1, 5)),
            (9, "P9", "c", "c", None, "1.00", D(2025, 1, 5, 0, 0, 1)),
            (10, "P10", "d", "c", None, "1.00", hwm - dt.timedelta(days=1, seconds=1)),
        ],
        SRC,
    )
    r = pipeline.stage_table(spark, s, src, None, stg, control, D(2025, 1, 5))
    assert sorted(x.product_key for x in stg.read(r.version).collect()) == [7, 8]


def test_full_load_deletes_absent_rows_and_ignores_audit(spark):
    stg, cur, control = tables(spark, "pipe_full")
    s = spec(load_mode=LoadMode.FULL)
    pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    smaller = seed(spark).where("product_key <> 2")
    audit = spark.createDataFrame([(3, 1, "D", D(2025, 1, 2))], AUDIT)
    r = pipeline.stage_table(spark, s, smaller, audit, stg, control, D(2025, 1, 3))
    assert r.tombstones == 0
    m = pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 3))
    assert m.actions["delete"] == 1
    assert [x[0] for x in current_rows(cur)] == [1, 3]


def test_wrong_count_is_never_served_and_records_skip(spark):
    stg, cur, control = tables(spark, "pipe_rollback")
    s = spec()
    pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    before = current_rows(cur)
    batch = spark.createDataFrame([(4, "P4", "mug", "home", None, "4.00", D(2025, 1, 7))], SRC)
    pipeline.stage_table(spark, s, batch, None, stg, control, D(2025, 1, 8))
    with pytest.raises(CheckFailed):
        pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 8), expected_override=999)
    assert current_rows(cur) == before  # the old version is what readers see
    row = control.row("dim_product")
    assert row.skip_versions == "1" and row.last_version_run == 0
    assert cur.current().version == 0  # the bad version has data but no commit
    # The batch is still pending: a retry merges it, with what was staged meanwhile.
    later = spark.createDataFrame([(5, "P5", "cup", "home", None, "5.00", D(2025, 1, 8))], SRC)
    pipeline.stage_table(spark, s, later, None, stg, control, D(2025, 1, 9))
    m = pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 9))
    assert m.actions["insert"] == 2
    assert [x[0] for x in current_rows(cur)] == [*(x[0] for x in before), 4, 5]


def test_failed_first_merge_serves_nothing(spark):
    stg, cur, control = tables(spark, "pipe_first_fails")
    s = spec()
    pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    with pytest.raises(CheckFailed):
        pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2), expected_override=999)
    assert not cur.exists()
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    assert [x[0] for x in current_rows(cur)] == [1, 2, 3]


@pytest.mark.parametrize("fail", [False, True])
def test_every_staged_batch_is_merged(spark, fail):
    """Three stage jobs before one merge; or a merge that fails in between."""
    stg, cur, control = tables(spark, f"pipe_pending_{fail}")
    s = spec()
    one = lambda k, price, day: spark.createDataFrame([(k, f"P{k}", "mug", "home", None, price, D(2025, 1, day))], SRC)
    pipeline.stage_table(spark, s, one(1, "1.00", 1), None, stg, control, D(2025, 1, 2))
    pipeline.stage_table(spark, s, one(2, "2.00", 3), None, stg, control, D(2025, 1, 4))
    if fail:
        with pytest.raises(CheckFailed):
            pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 4), expected_override=7)
    pipeline.stage_table(spark, s, one(1, "9.00", 5), None, stg, control, D(2025, 1, 6))
    pipeline.stage_table(spark, s, one(3, "3.00", 7), None, stg, control, D(2025, 1, 8))
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 8))
    rows = cur.read().orderBy("product_key").collect()
    assert [r["product_key"] for r in rows] == [1, 2, 3]
    assert "9.00" in str(rows[0])  # the latest of several staged rows of a key


def test_reopening_with_another_layout_keeps_one_row_per_key(spark):
    base = tables(spark, "pipe_layout")
    stg, control = base[0], base[2]
    path, s = f"{stg.path}-current", spec()
    for buckets, day in ((4, 2), (8, 4), (16, 6), (0, 8)):
        cur = SnapshotTable(spark, path, s.keys if buckets else None, buckets)
        rows = [(k, f"P{k}", "mug", "home", None, f"{day}.00", D(2025, 1, day)) for k in range(40)]
        pipeline.stage_table(spark, s, spark.createDataFrame(rows, SRC), None, stg, control, D(2025, 1, day + 1))
        pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, day + 1))
        assert sorted(r["product_key"] for r in cur.read().collect()) == list(range(40))
    with pytest.raises(ValueError):
        SnapshotTable(spark, path, s.keys, 4).touched_buckets(cur.read())


def test_duplicate_batch_keys_fail_before_merge(spark):
    stg, cur, control = tables(spark, "pipe_dup")
    s = spec()
    dup = seed(spark).unionByName(seed(spark).where("product_key = 1"))
    pipeline.stage_table(spark, s, dup, None, stg, control, D(2025, 1, 2))
    with pytest.raises(CheckFailed):
        pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    assert not cur.exists()


def test_row_numbered_staging(spark):
    stg, cur, control = tables(spark, "pipe_rownum")
    s = spec()
    r = pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2), number=True)
    got = stg.read(r.version)
    assert got.columns[0] == "row_number"
    assert sorted((x.row_number, x.product_key) for x in got.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_run_tables_orders_parents_first(spark):
    cfg = {
        "fact_sales": {"primary_keys": ["sales_key"], "full_load_table": True, "foreign_keys": [["product_key", "dim_product", "product_key"]]},
        "dim_product": {"primary_keys": ["product_key"], "full_load_table": True},
        "dim_store": {"primary_keys": ["store_key"], "full_load_table": True, "skip": True},
    }
    specs = load_specs(cfg)
    assert [x.name for x in specs] == ["dim_product", "fact_sales", "dim_store"]
    sales = spark.createDataFrame([(1, 1, 2)], "sales_key int, product_key int, quantity_sold int")
    products = seed(spark).select("product_key", "product_id")
    out = pipeline.run_tables(spark, specs, {"fact_sales": sales, "dim_product": products}, {}, work_dir(spark, "pipe_run"), D(2025, 1, 2))
    assert set(out) == {"dim_product", "fact_sales"}
    assert out["fact_sales"][1].actions["insert"] == 1
    assert out["fact_sales"][2] == {"product_key->dim_product.product_key": 0}
    orphan_sales = spark.createDataFrame([(2, 99, 1)], "sales_key int, product_key int, quantity_sold int")
    out2 = pipeline.run_tables(spark, specs, {"fact_sales": orphan_sales, "dim_product": products}, {}, work_dir(spark, "pipe_run2"), D(2025, 1, 2))
    assert out2["fact_sales"][2] == {"product_key->dim_product.product_key": 1}


def test_bucket_scoped_merge_rewrites_only_touched_buckets(spark):
    base = work_dir(spark, "pipe_buckets")
    stg = SnapshotTable(spark, f"{base}/staging")
    cur = SnapshotTable(spark, f"{base}/current", ("o_orderkey",), 64)
    control = ctl.ControlTable(spark, f"{base}/_control")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    s = TableSpec("orders", ("o_orderkey",), LoadMode.INCREMENTAL, update_col="o_orderdate")
    pipeline.stage_table(spark, s, orders, None, stg, control, D(2001, 8, 1))
    m0 = pipeline.merge_table(spark, s, stg, cur, control, D(2001, 8, 1))
    v0 = cur.current()
    assert len(v0.manifest) == 64 and v0.rows == orders.count()
    # two changed rows and one new key, all dated after the mark
    changed = orders.where("o_orderkey in (1, 2)").withColumn("o_orderdate", F.lit(D(2001, 9, 1)).cast("timestamp_ntz"))
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = orders.where("o_orderkey = 3").withColumn("o_orderkey", F.lit(10_000_000).cast("long")).withColumn(
        "o_orderdate", F.lit(D(2001, 9, 1)).cast("timestamp_ntz")
    )
    pipeline.stage_table(spark, s, changed.unionByName(new), None, stg, control, D(2001, 9, 2))
    m1 = pipeline.merge_table(spark, s, stg, cur, control, D(2001, 9, 2))
    v1 = cur.current()
    rewritten = {b for b, entry in v1.manifest.items() if entry[0] == v1.data_version}
    assert 1 <= len(rewritten) <= 3
    assert all(v1.manifest[b] == v0.manifest[b] for b in v1.manifest if b not in rewritten)
    assert m1.actions["update"] == 2 and m1.actions["insert"] == 1 and m1.check.ok
    got = cur.read()
    assert got.count() == orders.count() + 1
    assert got.where("o_orderkey = 1").first().o_totalprice == orders.where("o_orderkey = 1").first().o_totalprice + 1
    touched_keys = {r.o_orderkey for r in cur.read(buckets=[int(b) for b in rewritten]).select("o_orderkey").collect()}
    assert {1, 2, 10_000_000} <= touched_keys


def test_staging_schema_may_declare_bookkeeping_columns(spark):
    stg, cur, control = tables(spark, "pipe_declared")
    declared = T.StructType(
        [T.StructField("row_number", T.LongType(), False)]
        + PRODUCT.fields
        + [T.StructField("is_deleted", T.BooleanType(), False)]
    )
    s = spec(staging_schema=declared)
    r = pipeline.stage_table(spark, s, seed(spark), None, stg, control, D(2025, 1, 2))
    assert r.rejects == 0 and r.rows == 3
    got = stg.read(r.version)
    assert got.columns[0] == "row_number" and "is_deleted" in got.columns
    m = pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    assert m.actions["insert"] == 3 and "row_number" not in cur.read().columns


def test_env_paths_and_point_in_time_layer(spark):
    base = work_dir(spark, "pipe_env")
    cfg = {
        "dim_product": {
            "primary_keys": ["product_key"],
            "update_timestamp_col": "last_updt_col",
            "audit_seq_id": "audit_id",
            "staging_table": {"path": {"dev": f"{base}/stg/", "qa": ""}},
            "business_current_table": {"path": {"dev": f"{base}/bc/"}},
            "point_in_time": True,
            "point_in_time_table": {"path": {"dev": f"{base}/pit/", "qa": ""}},
        }
    }
    (s,) = load_specs(cfg, env="dev")
    assert s.staging_path == f"{base}/stg/dim_product" and s.current_path == f"{base}/bc/dim_product"
    (q,) = load_specs(cfg, env="qa")
    assert q.staging_path is None and q.point_in_time_path is None
    audit = spark.createDataFrame(
        [(1, 1, "I", D(2025, 1, 1)), (1, 2, "U", D(2025, 1, 3)), (2, 3, "I", D(2025, 1, 2))], AUDIT
    )
    src = seed(spark).select("product_key", "product_id", "last_updt_col")
    out = pipeline.run_tables(spark, [s], {"dim_product": src}, {"dim_product": audit}, f"{base}/root", D(2025, 1, 5))
    assert out["dim_product"][1].actions["insert"] == 3
    assert SnapshotTable(spark, f"{base}/bc/dim_product").read().count() == 3
    pit = SnapshotTable(spark, f"{base}/pit/dim_product").read()
    got = sorted((r.product_key, r.valid_from, r.valid_to, r.is_current) for r in pit.collect())
    assert got == [
        (1, D(2025, 1, 1), D(2025, 1, 3), False),
        (1, D(2025, 1, 3), None, True),
        (2, D(2025, 1, 2), None, True),
    ]


def test_bucket_scoped_merge_aligns_key_types(spark):
    base = work_dir(spark, "pipe_keytypes")
    stg = SnapshotTable(spark, f"{base}/staging")
    cur = SnapshotTable(spark, f"{base}/current", ("k",), 8)
    control = ctl.ControlTable(spark, f"{base}/_control")
    s = TableSpec("t", ("k",), LoadMode.INCREMENTAL, update_col="u")
    first = spark.createDataFrame([(i, "a", D(2025, 1, 1)) for i in range(50)], "k long, v string, u timestamp_ntz")
    pipeline.stage_table(spark, s, first, None, stg, control, D(2025, 1, 2))
    pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 2))
    # the next batch arrives with INT keys; it must still land in the right buckets
    second = spark.createDataFrame([(i, "b", D(2025, 1, 3)) for i in range(0, 50, 7)], "k int, v string, u timestamp_ntz")
    pipeline.stage_table(spark, s, second, None, stg, control, D(2025, 1, 4))
    m = pipeline.merge_table(spark, s, stg, cur, control, D(2025, 1, 4))
    assert m.actions["update"] == 8 and m.actions["insert"] == 0
    got = cur.read()
    assert got.count() == 50 and got.where("v = 'b'").count() == 8


def test_command_line_jobs(spark, tmp_path):
    import json as _json

    from lakeloom import jobs

    base = work_dir(spark, "cli")
    src = f"{base}/src"
    seed(spark).withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")).write.parquet(f"{src}/dim_product")
    spark.createDataFrame([(2, 1, "D", D(2025, 1, 1, 12))], AUDIT).write.parquet(f"{src}/dim_product_audit")
    cfg = tmp_path / "tables.json"
    cfg.write_text(_json.dumps({
        "dim_product": {
            "primary_keys": ["product_key"], "update_timestamp_col": "last_updt_col", "audit_seq_id": "audit_id",
            "columns": [[f.name, f.dataType.simpleString().upper(), f.nullable] for f in PRODUCT.fields],
        }
    }))
    common = ["--tables", str(cfg), "--root", f"{base}/lake"]
    assert jobs.main(["bootstrap", *common]) == 0
    assert jobs.main(["stage", *common, "--run-date", "20250102", "--parquet-dir", src]) == 0
    assert jobs.main(["merge", *common, "--run-date", "20250102", "--keep-versions", "1"]) == 0
    layout = pipeline.Layout(f"{base}/lake")
    (s,) = load_specs(_json.loads(cfg.read_text()))
    cur = layout.current(spark, s)
    assert sorted(r.product_key for r in cur.read().collect()) == [1, 3]  # product 2 deleted by the audit log
    assert jobs.parse_run_date("20251120") == D(2025, 11, 20)


def test_sequence_watermark_with_audit_log(spark):
    stg, cur, control = tables(spark, "pipe_seq")
    s = TableSpec("fact_sales", ("sales_key",), LoadMode.INCREMENTAL, update_col="sales_key", audit_seq_col="audit_id", overlap=0)
    sales = spark.createDataFrame([(i, i * 10) for i in range(1, 8)], "sales_key long, amount long")
    r = pipeline.stage_table(spark, s, sales, None, stg, control, 1_000_000)
    assert r.high_water_mark == 7
    pipeline.merge_table(spark, s, stg, cur, control, 1_000_000)
    more = spark.createDataFrame([(i, i * 10) for i in range(8, 10)], "sales_key long, amount long")
    audit = spark.createDataFrame([(3, 1, "D", D(2025, 1, 1))], "sales_key long, audit_id long, operation_type string, operation_timestamp timestamp_ntz")
    r = pipeline.stage_table(spark, s, sales.where("sales_key <> 3").unionByName(more), audit, stg, control, 1_000_000)
    assert (r.rows, r.tombstones, r.high_water_mark) == (4, 1, 9)  # keys 7, 8, 9 (overlap 0 re-reads the mark) + tombstone 3
    pipeline.merge_table(spark, s, stg, cur, control, 1_000_000)
    assert sorted(x.sales_key for x in cur.read().collect()) == [1, 2, 4, 5, 6, 7, 8, 9]


def test_range_buckets_rewrite_only_new_key_ranges(spark):
    base = work_dir(spark, "pipe_range")
    layout = pipeline.Layout(f"{base}/lake", bucket_width=100)
    s = TableSpec("fact", ("sales_key",), LoadMode.INCREMENTAL, update_col="sales_key", overlap=0)
    first = spark.range(0, 1000).select(F.col("id").alias("sales_key"), (F.col("id") % 7).alias("qty"))
    pipeline.stage_tables(spark, [s], {"fact": first}, {}, layout, 10**9)
    pipeline.merge_tables(spark, [s], layout, 10**9)
    cur = layout.current(spark, s)
    assert sorted(int(b) for b in cur.current().manifest) == list(range(10))
    # appended keys 1000..1049 plus a re-read of the mark (999): only buckets 9 and 10 change
    more = spark.range(999, 1050).select(F.col("id").alias("sales_key"), F.lit(1).cast("long").alias("qty"))
    pipeline.stage_tables(spark, [s], {"fact": first.unionByName(more).dropDuplicates(["sales_key"])}, {}, layout, 10**9)
    pipeline.merge_tables(spark, [s], layout, 10**9)
    v0, v1 = cur.commit(cur.current().version - 1), cur.current()
    assert cur.changed_buckets(v0.version, v1.version) == [9, 10]
    assert cur.read().count() == 1050 and cur.stored_rows() == 1050


def test_command_line_jdbc_wiring_without_a_database(spark, tmp_path, monkeypatch):
    """The JDBC path of the jobs, with the two JDBC readers replaced by stubs
    that serve parquet: checks table naming, the audit table and the report."""
    import json as _json

    from lakeloom import jobs

    base = work_dir(spark, "cli_jdbc")
    seed(spark).withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")).write.parquet(f"{base}/dim_product")
    spark.createDataFrame([(3, 1, "D", D(2025, 1, 1, 12))], AUDIT).write.parquet(f"{base}/dim_product_audit")
    calls = []

    def fake_population(spark_, src, spec, hwm, run_ts, schema_name=None, **kw):
        from lakeloom.plans.read_plan import ReadPlan

        calls.append(("population", spec.name, schema_name, src.url))
        return spark_.read.parquet(f"{base}/{spec.name}"), ReadPlan(None, None, None, 1, 3)

    def fake_jdbc(spark_, src, dbtable, plan=None, reader=None):
        calls.append(("table", dbtable))
        return spark_.read.parquet(f"{base}/{dbtable.split('.')[-1]}")

    monkeypatch.setattr(jobs, "read_population", fake_population)
    monkeypatch.setattr(jobs, "read_jdbc", fake_jdbc)
    monkeypatch.setattr("lakeloom.sources.jdbc.read_jdbc", fake_jdbc)
    cfg = tmp_path / "load.json"
    cfg.write_text(_json.dumps({"dim_product": {"primary_keys": ["product_key"], "update_timestamp_col": "last_updt_col", "audit_seq_id": "audit_id"}}))
    args = ["run", "--tables", str(cfg), "--root", f"{base}/lake", "--run-date", "20250102",
            "--jdbc-url", "jdbc:postgresql://db/x", "--db-schema", "products"]
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert jobs.main(args) == 0
    report = _json.loads(out.getvalue().strip().splitlines()[-1])
    stage = report["stage"]["dim_product"]
    assert (stage["rows"], stage["tombstones"], stage["source_rows"]) == (3, 1, 3)
    assert stage["source_drift"] == -1  # product 3 was read live, then dropped by the later delete
    assert ("population", "dim_product", "products", "jdbc:postgresql://db/x") in calls
    assert ("table", "products.dim_product_audit") in calls
    (s,) = load_specs(_json.loads(cfg.read_text()))
    assert sorted(r.product_key for r in pipeline.Layout(f"{base}/lake").current(spark, s).read().collect()) == [1, 2]


def test_a_sequence_table_runs_from_its_config(spark, tmp_path):
    """The watermark's kind follows from the column; a run date does not bound a sequence."""
    import json as _json

    from lakeloom import jobs

    base = work_dir(spark, "cli_sequence")
    cfg = tmp_path / "load.json"
    cfg.write_text(_json.dumps({"sales": {"primary_keys": ["sales_key"], "update_timestamp_col": "sales_key", "partition_key": "row_number", "num_partition": 2}}))
    args = ["run", "--tables", str(cfg), "--root", f"{base}/lake", "--parquet-dir", f"{base}/src"]
    spark.range(1, 5).selectExpr("id AS sales_key", "id * 2 AS qty").write.parquet(f"{base}/src/sales")
    assert jobs.main([*args, "--run-date", "20250102"]) == 0
    spark.range(5, 8).selectExpr("id AS sales_key", "id * 2 AS qty").write.mode("append").parquet(f"{base}/src/sales")
    assert jobs.main([*args, "--run-date", "20250103"]) == 0
    (s,) = load_specs(_json.loads(cfg.read_text()))
    layout = pipeline.Layout(f"{base}/lake")
    assert sorted(r.sales_key for r in layout.current(spark, s).read().collect()) == list(range(1, 8))
    assert layout.staging(spark, s).current().rows == 4  # the mark and what follows it


def test_merge_job_needs_the_audit_log_of_point_in_time_tables(spark, tmp_path):
    import json as _json

    from lakeloom import jobs

    base = work_dir(spark, "cli_pit")
    cfg = tmp_path / "load.json"
    cfg.write_text(_json.dumps({"dim_product": {"primary_keys": ["product_key"], "update_timestamp_col": "last_updt_col", "audit_seq_id": "audit_id", "point_in_time": True}}))
    seed(spark).write.parquet(f"{base}/src/dim_product")
    log = [(1, 1, "I", D(2025, 1, 1, 9)), (3, 2, "I", D(2025, 1, 1, 9)), (3, 3, "D", D(2025, 1, 1, 12))]
    spark.createDataFrame(log, AUDIT).write.parquet(f"{base}/src/dim_product_audit")
    common = ["--tables", str(cfg), "--root", f"{base}/lake", "--run-date", "20250102"]
    assert jobs.main(["stage", *common, "--parquet-dir", f"{base}/src"]) == 0
    with pytest.raises(SystemExit):
        jobs.main(["merge", *common])
    assert jobs.main(["merge", *common, "--parquet-dir", f"{base}/src"]) == 0
    (s,) = load_specs(_json.loads(cfg.read_text()))
    hist = pipeline.Layout(f"{base}/lake").history(spark, s).read().collect()
    assert sorted((r.product_key, r.valid_to, r.is_current) for r in hist) == [(1, None, True), (3, D(2025, 1, 1, 12), False)]


def test_config_as_written_for_the_loader():
    schemas = {"product_schema": [["product_key", "INT", False], ["price", "DECIMAL(10,2)"]]}
    cfg = {
        "primary_keys": ["product_key"],
        "staging_table": {"schema": "product_schema"},
        "partition_key": "row_number",
        "num_partition": 2,
        "newer_than_guard": True,
        "delete_op": "X",
        "audit_op_col": "op",
        "audit_time_col": "at",
    }
    (s,) = load_specs({"product": cfg}, schemas=schemas)
    assert s.staging_schema.fieldNames() == ["product_key", "price"]
    assert (s.newer_than_guard, s.delete_op, s.audit_op_col, s.audit_time_col) == (True, "X", "op", "at")
    assert s.resolved(s.staging_schema).partition_col == "product_key"
    with pytest.raises(ValueError):
        load_specs({"product": cfg}, schemas={})


@pytest.mark.parametrize("buckets", [0, 4])
def test_history_grows_by_new_entries(spark, buckets):
    base = work_dir(spark, "pit_grows")
    log = [(1, 1, "I", 1), (2, 2, "I", 2), (1, 3, "U", 3), (2, 4, "D", 4), (3, 5, "I", 5), (None, 6, "I", 6), (1, 7, "D", 7), (2, 8, "I", 8), (None, 9, "U", 9), (4, 10, "I", 10)]
    audit = spark.createDataFrame([(k, i, op, D(2025, 1, d)) for k, i, op, d in log], AUDIT)
    s = spec(point_in_time=True)
    grown = SnapshotTable(spark, f"{base}/grown", s.keys if buckets else None, buckets)
    for upto in (3, 4, 4, 7, 10):
        pipeline.build_history(s, audit.where(F.col("audit_id") <= upto), grown)
    whole = SnapshotTable(spark, f"{base}/whole")
    pipeline.build_history(s, audit, whole)
    cols = sorted(whole.read().columns)
    assert sorted(map(str, grown.read().select(cols).collect())) == sorted(map(str, whole.read().select(cols).collect()))
    assert grown.current().version == 3  # a build without new entries writes nothing
