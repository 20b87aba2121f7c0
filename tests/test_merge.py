import pytest
from pyspark.sql import functions as F

from lakeloom.operators import checks
from lakeloom.operators.merge import ACTION, expected_count, merge, merge_actions

SCHEMA = "k long, a string, b double"
SSCHEMA = "k long, a string, b double, is_deleted boolean"
STRATS = ["full_outer", "broadcast"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def actions(df):
    return {r["k"]: r[ACTION] for r in df.select("k", ACTION).collect()}


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (4, "w", 4.0)], SCHEMA)


@pytest.mark.parametrize("strategy", STRATS)
def test_tombstone_deletes_not_nulls(spark, target, strategy):
    src = spark.createDataFrame([(1, None, None, True)], SSCHEMA)
    out = merge(target, src, ["k"], "incremental", strategy=strategy)
    assert rows(out) == [(2, None, 2.0), (3, "z", None), (4, "w", 4.0)]


@pytest.mark.parametrize("strategy", STRATS)
def test_tombstone_unknown_key_is_ignored(spark, target, strategy):
    src = spark.createDataFrame([(99, None, None, True)], SSCHEMA)
    acts = merge_actions(target, src, ["k"], "incremental", strategy=strategy)
    assert actions(acts)[99] == "ignore"
    assert rows(acts.where(F.col(ACTION) != "ignore").drop(ACTION)) == rows(target)


@pytest.mark.parametrize("strategy", STRATS)
def test_null_transitions_update_and_null_equals_null(spark, target, strategy):
    src = spark.createDataFrame(
        [(2, "now", 2.0, False), (3, "z", 3.0, False), (1, None, 1.0, False), (4, "w", 4.0, False)], SSCHEMA
    )
    src_same_null = spark.createDataFrame([(2, None, 2.0, False)], SSCHEMA)
    acts = actions(merge_actions(target, src, ["k"], "incremental", strategy=strategy))
    assert acts == {1: "update", 2: "update", 3: "update", 4: "unchanged"}
    same = actions(merge_actions(target, src_same_null, ["k"], "incremental", strategy=strategy))
    assert same[2] == "unchanged"


@pytest.mark.parametrize("strategy", STRATS)
def test_insert_update_delete_keep(spark, target, strategy):
    src = spark.createDataFrame([(1, "x2", 1.0, False), (2, None, None, True), (5, "new", 5.0, False)], SSCHEMA)
    acts = merge_actions(target, src, ["k"], "incremental", strategy=strategy)
    assert actions(acts) == {1: "update", 2: "delete", 3: "keep", 4: "keep", 5: "insert"}
    assert rows(merge(target, src, ["k"], "incremental", strategy=strategy)) == [
        (1, "x2", 1.0), (3, "z", None), (4, "w", 4.0), (5, "new", 5.0)
    ]
    # count identity: target + inserts - deletes == rows written
    assert expected_count(acts).first()["expected"] == 4


def test_full_merge_deletes_absent_and_ignores_tombstones(spark, target):
    src = spark.createDataFrame([(1, "x", 1.0, False), (5, "n", 5.0, False), (3, None, None, True)], SSCHEMA)
    out = merge(target, src, ["k"], "full")
    assert rows(out) == [(1, "x", 1.0), (5, "n", 5.0)]


def test_strategies_agree_and_merge_is_idempotent(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    t = o.where(F.col("o_orderkey") % 3 != 0).withColumn("o_totalprice", F.col("o_totalprice") + (F.col("o_orderkey") % 2))
    s = o.where(F.col("o_orderkey") % 5 != 1).withColumn("is_deleted", F.col("o_orderkey") % 11 == 0)
    a = merge(t, s, ["o_orderkey"], "incremental", strategy="full_outer")
    b = merge(t, s, ["o_orderkey"], "incremental", strategy="broadcast")
    assert rows(a) == rows(b)
    again = merge(a, s, ["o_orderkey"], "incremental", strategy="full_outer")
    assert rows(again) == rows(a)
    # full merge result equals the live source
    full = merge(t, s, ["o_orderkey"], "full")
    assert rows(full) == rows(s.where(~F.col("is_deleted")).drop("is_deleted"))


def test_newer_than_guard(spark):
    t = spark.createDataFrame([(1, "new", 10.0)], SCHEMA)
    s = spark.createDataFrame([(1, "old", 5.0, False)], SSCHEMA)
    guarded = merge(t, s, ["k"], "incremental", newer_col="b", strategy="full_outer")
    assert rows(guarded) == [(1, "new", 10.0)]
    unguarded = merge(t, s, ["k"], "incremental", strategy="full_outer")
    assert rows(unguarded) == [(1, "old", 5.0)]


def test_composite_keys(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "k long, a string, b double")
    s = spark.createDataFrame([(1, "b", 3.0, False), (1, "a", None, True)], SSCHEMA)
    out = merge(t, s, ["k", "a"], "incremental", strategy="broadcast")
    assert rows(out) == [(1, "b", 3.0)]


def test_duplicate_and_null_keys_rejected_before_merge(spark):
    dup = spark.createDataFrame([(1, "a", 1.0, False), (1, "b", 2.0, False)], SSCHEMA)
    with pytest.raises(checks.CheckFailed):
        checks.require_keys_valid(dup, ["k"])
    nul = spark.createDataFrame([(None, "a", 1.0, False)], SSCHEMA)
    with pytest.raises(checks.CheckFailed):
        checks.require_keys_valid(nul, ["k"])
    checks.require_keys_valid(spark.createDataFrame([(1, "a", 1.0, False)], SSCHEMA), ["k"])
