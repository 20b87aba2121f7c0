import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.types import schema_from_columns, type_from_name
from lakeloom.operators import extract
from lakeloom.operators.numbering import number_rows
from lakeloom.plans.broadcast import check_size
from lakeloom.plans.read_plan import ReadPlan, plan_read
from lakeloom.plans.workspace import work_dir
from lakeloom.sources import files
from lakeloom.sources.jdbc import JdbcSource, jdbc_options, read_jdbc, subquery, table_ref
from lakeloom.sources.snapshots import SnapshotTable
from lakeloom.spec import LoadMode, TableSpec, check_identifier, load_specs


def test_type_names():
    assert type_from_name("LONG") == T.LongType()
    assert type_from_name("decimal") == T.DecimalType(25, 3)
    assert type_from_name("DECIMAL(10, 2)") == T.DecimalType(10, 2)
    assert type_from_name("timestamp_ntz") == T.TimestampNTZType()
    with pytest.raises(ValueError):
        type_from_name("BLOB")
    s = schema_from_columns([("id", "INT", False), ("name", "STRING")])
    assert s.fieldNames() == ["id", "name"] and not s["id"].nullable


def test_identifiers_and_specs():
    assert check_identifier("dim_product-1") == "dim_product-1"
    for bad in ("a;drop", "a b", "x'", ""):
        with pytest.raises(ValueError):
            check_identifier(bad)
    specs = load_specs(
        {
            "dim_customer": {"primary_keys": ["customer_key"], "full_load_table": True, "partition_key": "row_number", "num_partition": 2, "audit_seq_id": "NA"},
            "fact_sales": {"primary_keys": ["sales_key"], "update_timestamp_col": "sales_key", "overlap_seq": 100},
        }
    )
    c, f = specs
    assert c.load_mode == LoadMode.FULL and c.partition_col is None and not c.has_audit
    assert f.sequence_watermark and f.watermark_floor() == 0


def test_jdbc_options_without_a_database(monkeypatch):
    monkeypatch.setenv("LL_TEST_USER", "u")
    monkeypatch.setenv("LL_TEST_PASS", "p")
    src = JdbcSource("jdbc:postgresql://db:5432/x", driver="org.postgresql.Driver", user_env="LL_TEST_USER", password_env="LL_TEST_PASS")
    q = subquery(f"select * from {table_ref('products', 'dim_product')}", "pop")
    assert q == "(select * from products.dim_product) pop"
    single = jdbc_options(src, q)
    assert "partitionColumn" not in single and single["dbtable"] == q
    plan = ReadPlan("product_key", 1, 1000, 4, 1000)
    opts = jdbc_options(src, q, plan)
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("product_key", "1", "1000", "4")

    captured = {}

    class Reader:
        def format(self, f):
            captured["format"] = f
            return self

        def options(self, **o):
            captured.update(o)
            return self

        def load(self):
            return "frame"

    assert read_jdbc(None, src, q, plan, reader=Reader()) == "frame"
    assert captured["format"] == "jdbc" and captured["user"] == "u" and captured["password"] == "p"


def test_read_plan_from_bounds(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    p = plan_read(o, "o_orderkey", rows_per_partition=400)
    row = o.agg(F.min("o_orderkey"), F.max("o_orderkey"), F.count("*")).first()
    assert (p.lower, p.upper, p.row_count) == tuple(row) and p.num_partitions == 4 and p.partitioned
    assert not plan_read(o.where("false"), "o_orderkey").partitioned


def test_csv_headerless_ingest_and_rejects(spark):
    base = work_dir(spark, "csv_test")
    spark.createDataFrame([("ann", 1), ("bo", 2), ("cy", 3), ("di", 4)], "name string, id int").coalesce(1).write.csv(f"{base}/in")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.IntegerType())])
    table = SnapshotTable(spark, f"{base}/t")
    commit, _ = files.ingest_csv(spark, f"{base}/in", schema, table)
    assert commit.rows == 4
    spark.createDataFrame([("ok,1",), ("bad,x",)], "value string").coalesce(1).write.text(f"{base}/bad.csv")
    got = files.read_csv(spark, f"{base}/bad.csv", schema, keep_corrupt=True).collect()
    assert [(r.name, r.id, r[files.CORRUPT_COL] is not None) for r in got] == [("ok", 1, False), ("bad", None, True)]


def test_snapshot_versions_and_restore(spark):
    t = SnapshotTable(spark, work_dir(spark, "snap"))
    schema = T.StructType([T.StructField("k", T.LongType())])
    c0 = t.create_empty(schema)
    assert c0.version == 0 and t.read().count() == 0
    assert t.create_empty(schema).version == 0  # idempotent
    c1, _ = t.write(spark.range(5).withColumnRenamed("id", "k"))
    assert t.read().count() == 5 and c1.rows == 5
    t.restore(0)
    assert t.read().count() == 0 and t.read(1).count() == 5
    hist = [(r.version, r.data_version, r.operation) for r in t.history().collect()]
    assert hist == [(2, 0, "restore 0"), (1, 1, "write"), (0, 0, "create")]


def test_sequence_watermark_and_floor(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert extract.high_water_mark(o.where("false"), "o_orderdate").first()[0] == dt.datetime(1900, 1, 1)
    assert extract.high_water_mark_seq(o.where("false"), "o_orderkey").first()[0] == 0
    got = extract.extract_incremental(o, "o_orderkey", 100, 140, overlap=10)
    keys = sorted(r[0] for r in got.select("o_orderkey").collect())
    assert keys == sorted(r[0] for r in o.where("o_orderkey between 90 and 140").select("o_orderkey").collect())


def test_number_rows_matches_global_window(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderdate")
    got = number_rows(o, ["o_orderdate", "o_orderkey"], num_partitions=7)
    from pyspark.sql import Window

    ref = o.withColumn("row_number", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    tiny = number_rows(o.limit(3), ["o_orderkey"], num_partitions=16)  # mostly empty partitions
    assert sorted(r.row_number for r in tiny.collect()) == [1, 2, 3]


def test_size_check_is_bounded(spark):
    small = check_size(spark.range(10), max_rows=100)
    assert small.fits and small.rows == 10
    big = check_size(spark.range(1000), max_rows=100)
    assert not big.fits and big.rows == 1000
    # Strings count by their length.
    long = spark.range(10).selectExpr("repeat('x', 1000) AS text")
    assert check_size(long).bytes > 10_000 and not check_size(long, max_bytes=5_000).fits
    assert not check_size(spark.range(50), max_rows=100, max_bytes=10).fits


def test_sizing_helpers():
    from lakeloom.plans.sizing import buckets_for, recommended_settings, shuffle_partitions

    assert shuffle_partitions(100 << 40) == 409600
    assert shuffle_partitions(1, cores=8) == 8
    conf = recommended_settings(100 << 40, cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == "409600" and conf["spark.sql.adaptive.enabled"] == "true"
    assert buckets_for(100 << 40) == 131072 and buckets_for(1) == 1


def test_bucketed_table_splits_large_buckets(spark):
    t = SnapshotTable(spark, work_dir(spark, "bucket_files"), ("id",), 2, max_records_per_file=100)
    t.write(spark.range(1000))
    assert t.stored_rows() == 1000 and t.read().count() == 1000
    from lakeloom.plans.workspace import list_files

    files = [f for b in t.current().manifest for f in list_files(spark, f"{t.data_path(0)}/_bucket={b}") if f.endswith(".parquet")]
    assert len(files) >= 10


def test_jdbc_population_flow_without_a_database(spark):
    """Bounds on the filtered population, then a partitioned scan with the same
    predicate; a stand-in reader records options and serves parquet."""
    from lakeloom.sources.jdbc import read_population

    calls = []

    class Reader:
        def __init__(self):
            self.opts = {}

        def format(self, f):
            return self

        def options(self, **o):
            self.opts.update(o)
            return self

        def load(self):
            calls.append(dict(self.opts))
            return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")

    src = JdbcSource("jdbc:postgresql://db:5432/x")
    spec = TableSpec("orders", ("o_orderkey",), LoadMode.INCREMENTAL, update_col="o_orderdate", partition_col="o_orderkey", num_partitions=4)
    hwm, run = dt.datetime(2000, 1, 1), dt.datetime(2001, 8, 1)
    df, plan = read_population(spark, src, spec, hwm, run, schema_name="products", reader_factory=Reader)
    pop = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(
        F.col("o_orderdate").between(F.lit("1999-12-31").cast("timestamp_ntz"), F.lit("2001-08-01").cast("timestamp_ntz"))
    )
    row = pop.agg(F.min("o_orderkey"), F.max("o_orderkey"), F.count("*")).first()
    assert (plan.lower, plan.upper, plan.row_count, plan.num_partitions) == (row[0], row[1], row[2], 4)
    assert calls[0]["dbtable"] == "products.orders" and "partitionColumn" not in calls[0]
    assert calls[1]["partitionColumn"] == "o_orderkey" and calls[1]["numPartitions"] == "4"
    assert df.count() == pop.count()


def test_number_rows_spreads_ties(spark):
    tied = spark.range(0, 20000).select(F.lit(1).alias("g"), "id")
    nr = number_rows(tied, ["g"], num_partitions=8)
    per = nr.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("row_number").alias("m")).collect()
    assert len(per) == 8 and max(r["n"] for r in per) < 2 * 20000 / 8
    stats = nr.agg(F.min("row_number"), F.max("row_number"), F.countDistinct("row_number")).first()
    assert tuple(stats) == (1, 20000, 20000)


@pytest.mark.parametrize("buckets", [0, 4])
def test_write_after_a_lost_uncommitted_attempt(spark, buckets):
    t = SnapshotTable(spark, work_dir(spark, "orphan"), ("id",) if buckets else None, buckets)
    t.write(spark.range(3))
    # an earlier attempt at version 1 wrote data but never committed it
    spark.range(100, 150).write.parquet(t.data_path(1))
    c, _ = t.write(spark.range(10))
    assert c.version == 1 and c.data_dir != "v=1"
    assert sorted(r.id for r in t.read().collect()) == list(range(10))
    t.restore(0)
    assert t.read().count() == 3 and t.read(1).count() == 10


def test_vacuum_keeps_referenced_data(spark):
    t = SnapshotTable(spark, work_dir(spark, "vacuum"))
    for i in range(4):
        t.write(spark.range(i + 1))
    t.restore(1)  # version 4 serves the data of version 1
    removed = t.vacuum(keep_last=2)  # keeps versions 4 (data v=1) and 3
    assert sorted(p.rsplit("/", 1)[1] for p in removed) == ["v=0", "v=2"]
    assert t.read().count() == 2 and t.read(3).count() == 4
    assert t.vacuum(keep_last=2) == []

    b = SnapshotTable(spark, work_dir(spark, "vacuum_b"), ("id",), 4)
    b.write(spark.range(40))
    touched = sorted(r["b"] for r in spark.range(3).select(F.pmod(F.hash("id"), F.lit(4)).alias("b")).distinct().collect())
    b.write(spark.range(3).withColumn("id", F.col("id")), replace_buckets=touched)
    removed = b.vacuum(keep_last=1)
    # only the replaced buckets of version 0 go; its other buckets are still carried forward
    assert sorted(p.rsplit("/", 1)[1] for p in removed) == sorted(f"_bucket={x}" for x in touched)
    assert b.read().count() == b.stored_rows()
