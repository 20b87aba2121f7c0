"""Reconciliation, key filters, log compaction, balanced ranges, concurrent loads, keyed replay."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import bloom, changes, merge, reconcile
from lakeloom.plans import concurrent, pipeline, read_plan
from lakeloom.plans.control import KEPT_ROWS, ControlTable
from lakeloom.plans.workspace import list_files, work_dir
from lakeloom.sources.jdbc import JdbcSource, read_jdbc_ranges
from lakeloom.spec import LoadMode, TableSpec, order_specs
from lakeloom.streaming import keyed_state

# --- reconciliation


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reconcile_finds_every_difference_and_nothing_else(spark):
    rng = random.Random(2)
    before = [(k, rng.choice([None, 1, 2]), "x") for k in range(-500, 2000, 3)] + [(None, 1, "n")]
    after = [r for r in before if r[0] != 40]
    changed = {400: (400, 7, "x"), -497: (-497, None, "y"), 1999: (1999, 5, None)}
    after = [changed.get(r[0], r) for r in after] + [(9000, 1, "new"), (None, 2, "n")]
    rng.shuffle(after)
    b, a = (spark.createDataFrame(rows, "k long, v int, s string") for rows in (before, after))
    got = rows_of(reconcile.reconcile_ranges(b, a.select("s", "v", "k"), "k", 10, fanout=4))
    want = []
    leaves = {None if k is None else k // 10 for k in [40, 9000, None, *[k for k in changed if k in {r[0] for r in before}]]}
    for leaf in leaves:
        count = lambda rows: sum((r[0] is None) if leaf is None else (r[0] is not None and r[0] // 10 == leaf) for r in rows)
        want.append((None if leaf is None else leaf * 10, None if leaf is None else leaf * 10 + 10, count(before), count(after)))
    assert got == sorted(want, key=str)
    log = reconcile.differing_rows(b, a, ["k"], "k", 10, fanout=4).where("k IS NOT NULL").select("k", "operation_type")
    expected = [(40, "D") if 40 in {r[0] for r in before} else None, (9000, "I"), *[(k, "U") for k in changed if k in {r[0] for r in before}]]
    assert rows_of(log) == sorted((e for e in expected if e), key=str)


def test_reconcile_equal_empty_and_swapped(spark):
    rows = [(k, k * 2) for k in range(100)]
    a = spark.createDataFrame(rows, "k long, v long")
    none = a.limit(0)
    assert reconcile.reconcile_ranges(a, a.repartition(7), "k", 8).count() == 0
    assert reconcile.reconcile_ranges(none, none, "k", 8).count() == 0
    assert reconcile.reconcile_ranges(a, none, "k", 50).count() == 2
    # Equal sums of columns do not hide two values that were exchanged.
    swapped = a.select("k", F.when(F.col("k") == 3, 8).when(F.col("k") == 4, 6).otherwise(F.col("v")).alias("v"))
    assert rows_of(reconcile.reconcile_ranges(a, swapped, "k", 8).select("lower")) == [(0,)]
    stored = reconcile.range_digests(a.select("k", "v"), "k", 8)
    assert reconcile.reconcile_ranges(a, swapped, "k", 8, digests=(stored, None)).count() == 1
    with pytest.raises(ValueError):
        reconcile.reconcile_ranges(a, a.select("k"), "k", 8)


def test_differing_rows_reads_only_their_ranges(spark, monkeypatch):
    a = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    path = work_dir(spark, "reconcile")
    a.write.parquet(path)
    a = spark.read.parquet(path)
    b = a.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v")))
    log = reconcile.differing_rows(a, b, ["k"], "k", 10)
    assert "PushedFilters: [" in (plan := log._jdf.queryExecution().executedPlan().treeString()) or "GreaterThanOrEqual(k,70)" in plan
    assert rows_of(log.select("k", "operation_type")) == [(77, "U")]
    monkeypatch.setattr(reconcile, "FILTER_RANGES", 0)
    assert rows_of(reconcile.differing_rows(a, b, ["k"], "k", 10).select("k", "operation_type")) == [(77, "U")]


# --- merge through a key filter


def test_key_filter_passes_every_key_and_few_others(spark):
    batch = spark.range(0, 60_000, 6).select(F.col("id").alias("k"), F.lit("a").alias("j"))
    blocks = bloom.key_filter(batch, ["k", "j"], 10_000)
    every = spark.range(120_000).select(F.col("id").alias("k"), F.lit("a").alias("j"))
    marked = bloom.with_may_contain(every, ["k", "j"], blocks, 10_000, "may")
    inside = (F.col("k") % 6 == 0) & (F.col("k") < 60_000)
    hits, others = marked.agg(F.count_if(inside & F.col("may")), F.count_if(~inside & F.col("may"))).first()
    assert hits == 10_000
    assert others < 0.02 * 110_000


@pytest.mark.parametrize("n_keys", [0, 1, 300])
def test_bloom_merge_gives_the_shuffle_merge(spark, n_keys):
    rng = random.Random(n_keys)
    target = spark.createDataFrame([(k if k else None, rng.choice([None, 1, 2]), "t") for k in range(2000)], "k long, v int, s string")
    source = spark.createDataFrame([(k, rng.choice([None, 1, 2]), "t", rng.random() < 0.2) for k in rng.sample(range(1, 4000), n_keys)], "k int, v int, s string, is_deleted boolean")
    forms = [rows_of(merge.merge_actions(target, source, ["k"], strategy=s)) for s in ("bloom", "full_outer")]
    assert forms[0] == forms[1]


def test_bloom_merge_shuffles_a_small_part_of_the_target(spark):
    target = spark.range(200_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    source = spark.range(0, 200_000, 100).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))
    blocks = bloom.key_filter(source, ["k"], 2000)
    shuffled = bloom.with_may_contain(target, ["k"], blocks, 2000, "may").where("may").count()
    assert 2000 <= shuffled < 0.05 * 200_000
    plan = merge.merge_actions(target, source, ["k"], strategy="bloom")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "FullOuter" in plan


def test_strategy_by_measured_sizes(spark):
    batch = spark.range(10).select("id")
    pick = lambda target_rows, measured: merge.choose_strategy(batch, "incremental", "auto", 100, 10_000, measured, target_rows)
    assert pick(10**9, (50, 500)) == "broadcast"
    assert pick(10**9, (1000, 500)) == "bloom"
    assert pick(5000, (1000, 500)) == pick(None, (1000, 500)) == "full_outer"
    assert merge.choose_strategy(batch, "full", "bloom", 100, 100) == "full_outer"


# --- log compaction


def plain_compact(rows):
    out = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        first, last = mine[0][2] or "U", mine[-1][2] or "U"
        op = ("D" if first != "I" else None) if last == "D" else ("I" if first == "I" else "U")
        if op:
            out.append((k, mine[-1][3], op, mine[-1][1], mine[0][1], first, len(mine)))
    return sorted(out, key=str)


def test_compaction_is_associative(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, None]), s, rng.choice(["I", "U", "D", None]), s * 2) for s in range(150)]
    log = spark.createDataFrame(rows, "k long, seq long, operation_type string, v long")
    want = plain_compact(rows)
    assert rows_of(changes.compact_log(log, ["k"], "seq")) == want
    for width in (1, 7, 1000):
        parts = changes.compact_log(log, ["k"], "seq", bucket_width=width)
        assert rows_of(changes.compact_log(parts, ["k"], "seq", cols=["v"])) == want
        wider = changes.compact_log(parts, ["k"], "seq", cols=["v"], bucket_width=49)
        assert rows_of(changes.compact_log(wider, ["k"], "seq", cols=["v"])) == want
    # A state that the log applies to ends the same through the compacted log.
    state = spark.createDataFrame([(k, 0, -k) for k in range(4)], "k long, seq long, v long")
    raw, net = (changes.apply_change_log(state, x.select("k", "seq", "v", "operation_type").where("k IS NOT NULL"), ["k"], "seq") for x in (log, changes.compact_log(log, ["k"], "seq")))
    gone = {r[0] for r in rows} - {r[0] for r in want}
    assert [r for r in rows_of(raw) if r[0] not in gone] == [r for r in rows_of(net) if r[0] not in gone]


def test_compaction_reduces_a_hot_key_before_the_shuffle(spark):
    log = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.lit("U").alias("operation_type"), F.col("id").alias("v"))
    plan = changes.compact_log(log, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") >= 1 and plan.count("Exchange") == 1


# --- ranges of equal counts


def check_ranges(df, ranges, n, tolerance=1.2):
    total, nulls = df.agg(F.count("*"), F.count_if(F.col("k").isNull())).first()
    assert sum(r.rows for r in ranges) == total
    counts = df.agg(*[F.count_if(F.expr(r.predicate("k"))).alias(f"c{i}") for i, r in enumerate(ranges)]).first()
    assert [r.rows for r in ranges] == list(counts)
    for r in ranges:
        if r.rows > tolerance * (total - nulls) / n:
            assert df.where(F.expr(r.predicate("k"))).select("k").distinct().count() <= 1


def test_balanced_ranges_of_skewed_keys(spark):
    flat = spark.range(20_000).select(F.col("id").alias("k"))
    ranges = read_plan.balanced_ranges(flat, "k", 10)
    check_ranges(flat, ranges, 10)
    assert 9 <= len(ranges) <= 11
    # Equal widths would put all but a few rows into one range.
    skewed = flat.select(F.when(F.col("k") < 18_000, F.col("k") % 3000).otherwise(F.col("k") * 1_000_000).alias("k"))
    check_ranges(skewed, read_plan.balanced_ranges(skewed, "k", 10), 10)
    # A third of all rows have one key.
    hot = flat.select(F.when(F.col("k") % 3 == 0, 777).otherwise(F.col("k")).alias("k"))
    check_ranges(hot, read_plan.balanced_ranges(hot, "k", 8), 8)


def test_balanced_ranges_of_few_rows_nulls_and_text(spark):
    for rows in ([], [None], [None, None, 5], [5], [5] * 30, [1, 2, 3]):
        df = spark.createDataFrame([(k,) for k in rows], "k long")
        check_ranges(df, read_plan.balanced_ranges(df, "k", 4), 4)
    days = spark.range(500).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).cast("timestamp_ntz").alias("k"))
    check_ranges(days, read_plan.balanced_ranges(days, "k", 5), 5)


class Reader:
    """Records what a JDBC read is asked for."""

    def jdbc(self, **kw):
        self.asked = kw
        return "frame"


def test_jdbc_read_by_balanced_ranges():
    reader = Reader()
    ranges = [read_plan.KeyRange(None, 5, 10, True), read_plan.KeyRange(5, None, 11)]
    assert read_jdbc_ranges(None, JdbcSource("jdbc:x://h/db", driver="d"), "s.t", "k", ranges, reader=reader) == "frame"
    assert reader.asked["predicates"] == ["(k < 5 OR k IS NULL)", "k >= 5"]
    assert reader.asked["url"] == "jdbc:x://h/db" and reader.asked["table"] == "s.t" and reader.asked["properties"]["driver"] == "d"


# --- concurrent loads

PARENT = {"b": (("a_id", "a", "id"),), "c": (("b_id", "b", "id"),), "d": ()}


def specs():
    return [TableSpec(n, ("id",), LoadMode.FULL, foreign_keys=PARENT.get(n, ())) for n in "cbad"]


def test_levels():
    assert [[s.name for s in level] for level in concurrent.dependency_levels(specs())] == [["a", "d"], ["b"], ["c"]]
    assert concurrent.dependency_levels([]) == []


def test_a_failing_parent_stops_its_children_only(spark):
    sources = {n: spark.createDataFrame([(1, 1, 1), (2, 1, 2)], "id long, a_id long, b_id long") for n in "abcd"}
    sources["b"] = sources["b"].union(sources["b"])  # a key twice: refused before it is merged
    root = work_dir(spark, "levels")
    with pytest.raises(concurrent.LoadFailed) as e:
        concurrent.load_tables(spark, specs(), sources, {}, root, dt.datetime(2024, 1, 1))
    assert sorted(e.value.done) == ["a", "d"] and list(e.value.failed) == ["b"] and e.value.stopped == {"c": "b"}
    layout = pipeline.Layout(root)
    assert [layout.current(spark, s).exists() for s in sorted(specs(), key=lambda s: s.name)] == [True, False, False, True]


def test_side_by_side_gives_the_rows_of_one_after_the_other(spark):
    sources = {n: spark.createDataFrame([(i, i % 2, i % 3) for i in range(20)], "id long, a_id long, b_id long") for n in "abcd"}
    roots = [work_dir(spark, "levels") for _ in range(2)]
    one = pipeline.run_tables(spark, order_specs(specs()), sources, {}, roots[0], dt.datetime(2024, 1, 1))
    both = concurrent.load_tables(spark, specs(), sources, {}, roots[1], dt.datetime(2024, 1, 1))
    assert {k: v[2] for k, v in one.items()} == {k: v[2] for k, v in both.items()}
    for s in specs():
        assert rows_of(pipeline.Layout(roots[0]).current(spark, s).read()) == rows_of(pipeline.Layout(roots[1]).current(spark, s).read())


def test_control_rows_are_trimmed(spark):
    control = ControlTable(spark, work_dir(spark, "control"))
    for i in range(KEPT_ROWS + 8):
        control.mark_consumed("t", i, dt.datetime(2024, 1, 1))
    assert control.row("t").last_version_run == KEPT_ROWS + 7
    assert len(list_files(spark, f"{control.path}/t")) == KEPT_ROWS


# --- keyed replay


def test_keyed_replay_costs_a_batch_its_own_keys(spark):
    base = work_dir(spark, "keyed")
    schema = "k long, seq long, op string, v long"
    first = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("seq"), F.lit("I").alias("op"), F.col("id").alias("v"))
    first.write.parquet(f"{base}/log")
    read = first.schema
    run = lambda: keyed_state.replay_keyed(spark, f"{base}/log", read, ["k"], "seq", f"{base}/ckpt")
    assert sum(p["updated"] for p in run()) == 5000
    # Three keys, one entry older than what is held, one without sequence, one operation unknown.
    later = [(1, 9000, "D", 0), (2, 9001, None, 7), (3, -5, "U", 8), (4, None, "D", 9), (6000, 9002, "I", 1)]
    spark.createDataFrame(later, schema).coalesce(1).write.mode("append").parquet(f"{base}/log")
    progress = run()
    assert sum(p["updated"] for p in progress) == 5 and progress[-1]["state_rows"] == 5001
    rows = {r["k"]: (r["seq"], r["op"], r["v"]) for r in keyed_state.live_rows(spark, f"{base}/ckpt", "op").collect()}
    assert len(rows) == 5000 and 1 not in rows
    assert rows[2] == (9001, None, 7) and rows[3] == (3, "I", 3) and rows[4] == (4, "I", 4) and rows[6000] == (9002, "I", 1)
    assert run() == []
