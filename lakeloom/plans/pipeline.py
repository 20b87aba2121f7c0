"""Per-table jobs: stage (extract → tombstones → conform → write → check →
publish) and merge (staged batches → business-current version → check →
publish).

No staged batch is lost: a current version records the staging version it
holds, in its own commit, and a merge takes every later one, however many
stage jobs ran or merges failed in between. Data is checked before it is
published, so a version that fails a check is never served.

Each job builds one lazy DataFrame and writes it once; counts ride on the
write through ``Observation`` rather than extra passes over a live source.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.keys import any_null
from lakeloom.functions.literals import typed_lit
from lakeloom.operators import reconcile
from lakeloom.operators.batch_history import fold_batch, history_schema
from lakeloom.operators.changes import latest_deleted_keys
from lakeloom.operators.checks import CheckFailed, CountCheck, count_check, orphans, require_keys_valid
from lakeloom.operators.extract import extract, lower_bound
from lakeloom.operators.history import scd2
from lakeloom.operators.merge import (
    ACTION,
    DELETE,
    INSERT,
    KEEP,
    UNCHANGED,
    UPDATE,
    action_metrics,
    choose_strategy,
    initial_actions,
    merge_actions,
    merged_rows,
)
from lakeloom.operators.numbering import number_rows
from lakeloom.operators.sequences import islands, merge_intervals, unconsumed
from lakeloom.operators.staging import DELETE_FLAG, REJECT_COL, conform, stage_batch
from lakeloom.plans.broadcast import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, row_bytes
from lakeloom.plans.control import ControlTable
from lakeloom.plans.metrics import observed_values
from lakeloom.plans.sizing import buckets_for
from lakeloom.plans.workspace import checkpoint_dir, delete_path, empty_frame
from lakeloom.sources.snapshots import BUCKET, SLOT, Commit, SnapshotTable
from lakeloom.spec import TableSpec

ROW_NUMBER = "row_number"
_NTH = "_nth_of_key"
_STAGE_OP = "stage "


def _stage_operation(spec: TableSpec, run_ts) -> str:
    # A run bounded by a sequence number has no time of its own: when it happened.
    at = run_ts if isinstance(run_ts, dt.datetime) else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return f"{_STAGE_OP}{spec.load_mode.value} as of {at.isoformat(sep=' ')}"


def staged_full(commit: Commit) -> bool:
    """Whether a staged batch is a full load: by what was staged, not by what the spec says now."""
    return commit.operation.removeprefix(_STAGE_OP).startswith("full")


def staged_at(commit: Commit) -> dt.datetime:
    """The run time of a staged batch (of older commits that lack it, the time they were written)."""
    _, _, run_ts = commit.operation.partition(" as of ")
    return dt.datetime.fromisoformat(run_ts or commit.written_at)


@dataclass(frozen=True)
class StageResult:
    version: int
    rows: int
    tombstones: int
    rejects: int
    high_water_mark: object
    check: CountCheck


@dataclass(frozen=True)
class MergeResult:
    version: int
    strategy: str
    actions: dict
    check: CountCheck


def staged_frame(spec: TableSpec, source: DataFrame, audit: DataFrame | None, hwm, run_ts, number: bool = False, folders: list[str] | None = None) -> DataFrame:
    """The composed staging batch (live rows + tombstones, conformed, with ``_reject``);
    lazy, but for row numbers, whose work folder is added to ``folders``."""
    population = extract(source, spec, hwm, run_ts)
    deletes = None
    if audit is not None and spec.has_audit and not spec.is_full:
        # A time window on the operation time needs a time watermark; with a
        # sequence watermark the latest operation is taken over the whole log.
        windowed = spec.audit_time_col in audit.columns and not spec.sequence_watermark
        deletes = latest_deleted_keys(
            audit,
            spec.keys,
            spec.audit_seq_col,
            spec.audit_op_col,
            spec.delete_op,
            time_col=spec.audit_time_col if windowed else None,
            since=lower_bound(hwm, spec.overlap) if windowed else None,
            until=run_ts if windowed else None,
        )
    staged = stage_batch(population, deletes, keys=spec.keys)
    if spec.staging_schema is not None:
        # Bookkeeping columns a staging schema may declare are produced here,
        # not read from the source.
        declared = spec.staging_schema.fieldNames()
        number = number or ROW_NUMBER in declared
        business = T.StructType([f for f in spec.staging_schema.fields if f.name not in (ROW_NUMBER, DELETE_FLAG)])
        staged = conform(staged, business)
    else:
        staged = staged.withColumn(REJECT_COL, F.lit(None).cast("string"))
    if number:
        staged = number_rows(staged, spec.keys, name=ROW_NUMBER, folders=folders)
        staged = staged.select(ROW_NUMBER, *[c for c in staged.columns if c != ROW_NUMBER])
    return staged


def stage_table(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    audit: DataFrame | None,
    staging: SnapshotTable,
    control: ControlTable,
    run_ts,
    number: bool = False,
) -> StageResult:
    spec = spec.resolved(source.schema)
    floor = spec.watermark_floor()
    hwm = control.high_water_mark(spec.name, floor)
    folders: list[str] = []
    staged = staged_frame(spec, source, audit, hwm, run_ts, number, folders)
    live_ok = ~F.col(DELETE_FLAG) & F.col(REJECT_COL).isNull()
    extra = [
        F.count(F.when(F.col(DELETE_FLAG), 1)).alias("tombstones"),
        F.count(F.when(F.col(REJECT_COL).isNotNull(), 1)).alias("rejects"),
    ]
    if spec.update_col:
        extra.append(F.max(F.when(live_ok, F.col(spec.update_col))).alias("max_mark"))
    extra.append(F.sum(row_bytes(staged.schema)).alias("bytes"))
    try:
        commit, m = staging.stage_write(staged, operation=_stage_operation(spec, run_ts), observe=extra)
    finally:
        for folder in folders:
            delete_path(spark, folder)
    check = count_check(m["rows"], staging.rows_of(commit))
    if not check.ok:
        raise CheckFailed(f"{spec.name}: staging count {check.actual} <> expected {check.expected}")
    staging.publish(commit)
    mark = hwm
    if spec.update_col:
        mark = control.advance_mark(spec.name, m.get("max_mark"), floor, run_ts)
    return StageResult(commit.version, m["rows"], m["tombstones"], m["rejects"], mark, check)


def batch_from_staging(staging: SnapshotTable, version: int | None = None) -> DataFrame:
    staged = staging.read(version).where(F.col(REJECT_COL).isNull()).drop(REJECT_COL)
    return staged.drop(ROW_NUMBER) if ROW_NUMBER in staged.columns else staged


def pending_batches(staging: SnapshotTable, merged: int | None) -> list[Commit]:
    """Staged batches after version ``merged``, oldest first, of one load mode:
    a full load stands for all before it, and ends the list if incremental
    batches follow (they are merged next). With none left, the newest is
    merged again."""
    staged = [c for c in staging.commits_after(merged) if c.operation.startswith(_STAGE_OP)]
    if not staged:
        newest = staging.current()
        if newest is None:
            raise FileNotFoundError(f"{staging.path}: nothing staged")
        return [newest]
    last_full = max((i for i, c in enumerate(staged) if staged_full(c)), default=None)
    return staged if last_full is None else staged[last_full : last_full + 1]


def combined_batch(staging: SnapshotTable, commits: list[Commit], keys, validate: bool, what: str) -> DataFrame:
    """One batch of several staged ones: each key's row of the latest that has it."""
    keys, order = list(keys), "_staged"
    frames = [batch_from_staging(staging, c.version) for c in commits]
    if validate:
        for f in frames:
            require_keys_valid(f, keys, what=f"{what} batch")
    if len(frames) == 1:
        return frames[0]
    names = frames[-1].columns
    every = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        (f.withColumn(order, F.lit(c.version)) for f, c in zip(frames, commits)),
    )
    latest = every.groupBy(*keys).agg(F.max_by(F.struct(*[n for n in names if n not in keys]), order).alias("_row"))
    return latest.select(*[F.col(n) if n in keys else F.col(f"_row.{n}").alias(n) for n in names])


def merge_table(
    spark: SparkSession,
    spec: TableSpec,
    staging: SnapshotTable,
    current: SnapshotTable,
    control: ControlTable,
    run_ts,
    strategy: str = "auto",
    validate: bool = True,
    expected_override: int | None = None,
) -> MergeResult:
    """Merge all staged batches that the business-current table lacks into it:
    a full load on its own, then the incremental batches staged after it.

    The new version's count and keys are checked before it is published. If
    they are wrong it is not, its number goes into the control skip list, and
    ``CheckFailed`` is raised; the batches stay pending. Keys whose rows were
    rejected keep their stored rows on a full load.
    ``expected_override`` exists to exercise that failure path in tests.
    """
    while True:
        result = _merge_pending(spark, spec, staging, current, control, run_ts, strategy, validate, expected_override)
        if not any(c.operation.startswith(_STAGE_OP) for c in staging.commits_after(current.current().source_version)):
            return result


def _merge_pending(spark, spec: TableSpec, staging, current, control, run_ts, strategy, validate, expected_override) -> MergeResult:
    before = current.current()
    pending = pending_batches(staging, before.source_version if before is not None else None)
    full = staged_full(pending[-1])
    batch = combined_batch(staging, pending, spec.keys, validate, spec.name)
    target_schema = batch.drop(DELETE_FLAG).schema
    if before is not None and before.schema:
        # Keys must carry the target's types: bucket ids hash typed values.
        stored = T.StructType.fromJson(json.loads(before.schema))
        for k in spec.keys:
            if k in stored.fieldNames() and stored[k].dataType != batch.schema[k].dataType:
                batch = batch.withColumn(k, F.col(k).cast(stored[k].dataType))
    touched = None
    if current.bucketed and not full and before is not None and current.same_layout(before):
        # Bucket-scoped merge: only the buckets holding batch keys are read and
        # rewritten; the rest of the table is carried forward by reference.
        # At most one id per bucket reaches the driver.
        touched = current.touched_buckets(batch)
        target = current.read(buckets=touched)
    elif before is not None:
        target = current.read()
    else:
        target = empty_frame(spark, target_schema)
    mode = "full" if full else "incremental"
    if before is None or not before.rows:
        # First load (the commit log says the target is empty): every live row
        # is an insert; no join, no shuffle.
        plan = "initial"
        actions = initial_actions(batch, target_schema.fieldNames())
    else:
        # Rows and bytes written to staging bound the accepted batch.
        known = all(c.rows is not None and c.bytes is not None for c in pending)
        measured = (sum(c.rows for c in pending), sum(c.bytes for c in pending)) if known else None
        plan = choose_strategy(batch, mode, strategy, DEFAULT_MAX_ROWS, DEFAULT_MAX_BYTES, measured, before.rows if touched is None else None)
        newer = spec.update_col if spec.newer_than_guard else None
        refused = staging.read(pending[-1].version).where(F.col(REJECT_COL).isNotNull()) if full else None
        actions = merge_actions(target, batch, spec.keys, mode, newer_col=newer, strategy=plan, protected=refused, decided=True, batch_rows=measured[0] if measured else None)
    obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")  # unique per use
    in_write = current.bucketed and validate
    bad_keys = [F.count_if((F.col(_NTH) > 1) | any_null(spec.keys)).alias("bad_keys")]

    def finish(df: DataFrame) -> DataFrame:
        rows = merged_rows(df.observe(obs, *action_metrics()))
        # Rows of a bucket lie in one task here: equal keys are found by its sort, without another shuffle.
        return rows.withColumn(_NTH, F.row_number().over(Window.partitionBy(SLOT, BUCKET, *spec.keys).orderBy(*spec.keys))) if in_write else rows

    commit, written = current.stage_write(
        actions,
        operation=f"merge {mode}",
        observe=bad_keys if in_write else None,
        replace_buckets=touched,
        finish=finish,
        source_version=pending[-1].version,
        drop=[_NTH],
    )
    counts = observed_values(obs, actions, action_metrics())
    if full:
        expected = counts[KEEP] + counts[INSERT] + counts[UPDATE] + counts[UNCHANGED]
    else:
        prev_rows = before.rows if before is not None else 0
        expected = (prev_rows or 0) + counts[INSERT] - counts[DELETE]
    if expected_override is not None:
        expected = expected_override
    check = count_check(expected, current.rows_of(commit))
    if not check.ok:
        control.record_skip(spec.name, commit.version, run_ts)
        raise CheckFailed(f"{spec.name}: merged count {check.actual} <> expected {check.expected}; version {commit.version} is not served")
    if validate and not (in_write and not written["bad_keys"]):
        # Counts cannot see a key stored twice: the rewritten part has one row per key.
        try:
            require_keys_valid(current.read_commit(commit, touched), spec.keys, what=f"{spec.name} version {commit.version}")
        except CheckFailed:
            control.record_skip(spec.name, commit.version, run_ts)
            raise
    current.publish(commit)
    control.mark_consumed(spec.name, commit.version, run_ts)
    return MergeResult(commit.version, plan, dict(counts), check)


#: Tables whose first staged batch has so many bytes are stored bucketed unless a layout says otherwise.
BUCKETED_FROM = 8 << 30


@dataclass(frozen=True)
class Layout:
    """Where a spec's layers live: spec paths when configured, else under ``root``.

    ``buckets``: hash buckets of current tables (0: none). By default (None) a
    table keeps the layout it is stored with; one that is made now is bucketed,
    at about 1 GB a bucket, if what is staged for it has ``BUCKETED_FROM``
    bytes or more, so that an incremental batch rewrites the buckets of its
    keys alone.
    """

    root: str
    buckets: int | None = None
    bucket_width: int | None = None  # range buckets on a single integral key instead of hash buckets

    def staging(self, spark, spec: TableSpec) -> SnapshotTable:
        return SnapshotTable(spark, spec.staging_path or f"{self.root}/staging/{spec.name}")

    def current(self, spark, spec: TableSpec) -> SnapshotTable:
        return self._opened(spark, spec, spec.current_path or f"{self.root}/current/{spec.name}")

    def _opened(self, spark, spec: TableSpec, path: str) -> SnapshotTable:
        if self.buckets is not None or self.bucket_width:
            bucketed = self.buckets or self.bucket_width
            return SnapshotTable(spark, path, spec.keys if bucketed else None, self.buckets or 0, bucket_width=self.bucket_width)
        stored = SnapshotTable(spark, path).current()
        if stored is not None and stored.layout:
            return SnapshotTable(spark, path, stored.layout["keys"], stored.layout["buckets"], bucket_width=stored.layout["width"])
        if stored is not None and stored.rows:
            return SnapshotTable(spark, path)
        staged = self.staging(spark, spec).current()
        size = staged.bytes if staged is not None and staged.bytes else 0
        buckets = buckets_for(size) if size >= BUCKETED_FROM else 0
        return SnapshotTable(spark, path, spec.keys if buckets else None, buckets)

    def history(self, spark, spec: TableSpec) -> SnapshotTable:
        return self._opened(spark, spec, spec.point_in_time_path or f"{self.root}/point_in_time/{spec.name}")

    def control(self, spark) -> ControlTable:
        return ControlTable(spark, f"{self.root}/_control")


def bootstrap_tables(spark, specs, layout: Layout) -> dict:
    """Create empty staging and current tables from declared schemas, once
    (idempotent: tables with a version are left alone)."""
    made = {}
    for spec in specs:
        if spec.skip or spec.staging_schema is None:
            continue
        business = T.StructType([f for f in spec.staging_schema.fields if f.name not in (ROW_NUMBER, DELETE_FLAG)])
        leading = [T.StructField(ROW_NUMBER, T.LongType(), True)] if ROW_NUMBER in spec.staging_schema.fieldNames() else []
        trailing = [T.StructField(DELETE_FLAG, T.BooleanType(), True), T.StructField(REJECT_COL, T.StringType(), True)]
        staging_schema = T.StructType(leading + business.fields + trailing)
        made[spec.name] = (
            layout.staging(spark, spec).create_empty(staging_schema).version,
            layout.current(spark, spec).create_empty(business).version,
        )
    return made


def stage_tables(spark, specs, sources: dict, audits: dict, layout: Layout, run_ts) -> dict:
    """The stage job: every non-skipped table, parents first."""
    control = layout.control(spark)
    out = {}
    for spec in specs:
        if not spec.skip:
            out[spec.name] = stage_table(spark, spec, sources[spec.name], audits.get(spec.name), layout.staging(spark, spec), control, run_ts)
    return out


def merge_tables(
    spark, specs, layout: Layout, run_ts, strategy: str = "auto", audits: dict | None = None, keep_versions: int | None = None, related=None
) -> dict:
    """The merge job: pending staged batches of every non-skipped table into its
    current table, then point-in-time history (from the audit log where there
    is one, else from the staged batches) and foreign-key reports. With
    ``keep_versions``, data no longer referenced by that many newest commits
    of the staging and current tables is removed after a successful merge.
    ``related`` are specs of tables that foreign keys name, where ``specs`` is a part of a run."""
    control = layout.control(spark)
    audits = audits or {}
    loaded: dict[str, SnapshotTable] = {}
    by_name = {s.name: s for s in [*(related or ()), *specs]}
    out = {}
    for spec in specs:
        if not spec.skip and spec.point_in_time and spec.has_audit and spec.name not in audits:
            raise ValueError(f"{spec.name}: its point-in-time layer needs the audit log")
    for spec in specs:
        if spec.skip:
            continue
        current = layout.current(spark, spec)
        staging = layout.staging(spark, spec)
        mg = merge_table(spark, spec, staging, current, control, run_ts, strategy)
        loaded[spec.name] = current
        if spec.point_in_time and spec.has_audit:
            build_history(spec, audits[spec.name], layout.history(spark, spec))
        elif spec.point_in_time:
            build_history_from_batches(spec, staging, layout.history(spark, spec))
        if keep_versions:
            staging.vacuum(keep_versions)
            current.vacuum(keep_versions)
        # Parents that are not part of this run are taken as stored.
        for _, parent, _ in spec.foreign_keys:
            if parent not in loaded:
                stored = layout.current(spark, by_name.get(parent) or TableSpec(parent, spec.keys))
                if stored.exists():
                    loaded[parent] = stored
        out[spec.name] = (mg, foreign_key_report(spec, current, loaded))
    return out


def run_tables(
    spark, specs, sources: dict, audits: dict, root: str, run_ts, strategy: str = "auto", buckets: int | None = None,
    keep_versions: int | None = None, bucket_width: int | None = None,
) -> dict:
    """Stage and merge every non-skipped table, parents first.

    ``sources`` / ``audits`` map table name → DataFrame (JDBC, parquet, ...).
    Tables live at the spec's configured paths, else under ``root/<layer>/<table>``;
    the control table under ``root/_control``. ``buckets`` and ``bucket_width``:
    see :class:`Layout`. Returns ``{table: (StageResult, MergeResult, fk_report)}``.
    """
    layout = Layout(root, buckets, bucket_width)
    staged = stage_tables(spark, specs, sources, audits, layout, run_ts)
    merged = merge_tables(spark, specs, layout, run_ts, strategy, audits, keep_versions)
    return {name: (staged[name], *merged[name]) for name in merged}


def _same_keys(keys, prefix: str) -> Column:
    return reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys))


def _consumed_table(table: SnapshotTable) -> SnapshotTable:
    """Intervals of audit sequences that a point-in-time layer holds, stored beside it."""
    return SnapshotTable(table.spark, f"{table.path}/_consumed")


def build_history(spec: TableSpec, audit: DataFrame, table: SnapshotTable) -> Commit | None:
    """Point-in-time layer: validity intervals per key from the audit log
    (SCD2, ordered by the audit sequence).

    Which sequences a version holds is kept as merged intervals beside it. The
    next build reads entries after the last of them, ends the open intervals
    of their keys and adds theirs. Entries that became visible late, with
    numbers that earlier builds passed over, are found as well; the intervals of
    their keys are built anew from the log. Of a bucketed layer only the
    buckets of these keys are read and rewritten. An entry without sequence
    has no place in the history and is refused.
    """
    seq, time, keys = spec.audit_seq_col, spec.audit_time_col, list(spec.keys)
    spark, before = table.spark, table.current()
    consumed_table = _consumed_table(table)
    held = before.source_version if before is not None else None
    consumed = consumed_table.read() if held is not None and consumed_table.exists() else None
    last, unnumbered = audit.agg(F.max(seq), F.count_if(F.col(seq).isNull())).first()
    if unnumbered:
        raise CheckFailed(f"{spec.name}: {unnumbered} audit entries have no {seq}")
    cols = [c for c in audit.columns if c not in keys and c != seq]

    def intervals(log: DataFrame) -> DataFrame:
        return scd2(log, keys, seq, time, cols=cols, op_col=spec.audit_op_col, delete_op=spec.delete_op)

    touched = None
    if consumed is None:
        rows, now = intervals(audit), islands(audit, seq)
    else:
        checkpoint_dir(spark)
        new = audit.where(F.col(seq) > F.lit(held))
        late = unconsumed(audit.where(F.col(seq) <= F.lit(held)), seq, consumed).select(seq, *keys).checkpoint()
        n_late = late.count()
        if not n_late and (last is None or last <= held):
            return before
        late_keys = late.select(*[F.col(k).alias(f"_late_{k}") for k in keys]).distinct()
        if table.bucketed and table.same_layout(before):
            touched = table.touched_buckets(new.select(*keys).unionByName(late.select(*keys)))
        stored = table.read(buckets=touched)
        rows = intervals(audit.join(late_keys, _same_keys(keys, "_late_"), "left_semi")) if n_late else None
        if n_late:
            new, stored = (df.join(late_keys, _same_keys(keys, "_late_"), "left_anti") for df in (new, stored))
        ends = new.groupBy(*[F.col(k).alias(f"_new_{k}") for k in keys]).agg(F.min_by(time, seq).alias("_end"))
        joined = stored.join(ends, _same_keys(keys, "_new_"), "left")
        closed = F.col("is_current") & F.col("_end").isNotNull()
        old = joined.select(
            *[c for c in stored.columns if c not in ("valid_to", "is_current")],
            F.when(closed, F.col("_end")).otherwise(F.col("valid_to")).alias("valid_to"),
            (F.col("is_current") & F.col("_end").isNull()).alias("is_current"),
        )
        rows = reduce(DataFrame.unionByName, [old, intervals(new), *([rows] if n_late else [])])
        numbers = audit.where(F.col(seq) > F.lit(held)).select(seq).unionByName(late.select(seq))
        now = merge_intervals(consumed.unionByName(islands(numbers, seq)))
    commit, _ = table.stage_write(rows, operation="history", replace_buckets=touched, source_version=last)
    # Published before the intervals: a build lost in between finds its entries again and rebuilds their keys.
    published = table.publish(commit)
    consumed_table.write(now, operation=f"consumed by version {commit.version}")
    return published


def build_history_from_batches(spec: TableSpec, staging: SnapshotTable, table: SnapshotTable) -> Commit | None:
    """Point-in-time layer of a table without audit log: the net changes of
    every staged batch that the layer lacks, valid from the batch's run time.

    A version records the last staged batch it holds. Only the intervals of
    changed keys are closed and opened; of a bucketed layer an incremental
    batch reads and rewrites the buckets of its keys alone. On a full load,
    keys whose rows were rejected keep their intervals open.
    """
    before = table.current()
    held = before.source_version if before is not None else None
    staged = [c for c in staging.commits_after(held) if c.operation.startswith(_STAGE_OP)]
    if not staged:
        return before
    frames = [batch_from_staging(staging, c.version) for c in staged]
    touched = None
    if before is None:
        stored = empty_frame(table.spark, history_schema(T.StructType([f for f in frames[-1].schema.fields if f.name != DELETE_FLAG]), T.TimestampNTZType()))
    else:
        if table.bucketed and table.same_layout(before) and not any(staged_full(c) for c in staged):
            touched = table.touched_buckets(reduce(DataFrame.unionByName, (f.select(*spec.keys) for f in frames)))
        stored = table.read(buckets=touched)
    done, still_open = [stored.where("NOT is_current")], stored.where("is_current")
    for commit, frame in zip(staged, frames):
        full = staged_full(commit)
        refused = staging.read(commit.version).where(F.col(REJECT_COL).isNotNull()) if full else None
        folded = fold_batch(still_open, frame, spec.keys, typed_lit(staged_at(commit), T.TimestampNTZType()), full, protected=refused)
        done.append(folded.where("NOT is_current"))
        still_open = folded.where("is_current")
    rows = reduce(DataFrame.unionByName, [*done, still_open])
    commit, _ = table.stage_write(rows, operation="history", replace_buckets=touched, source_version=staged[-1].version)
    return table.publish(commit)


def reconcile_content(spec: TableSpec, source: DataFrame, current: SnapshotTable, ranges: int = 4096) -> DataFrame:
    """Key ranges in which the source and the business-current table hold
    different rows (``reconcile.reconcile_ranges``): counts alone cannot see a
    changed value. ``source`` is the whole source; columns the table has not are left out."""
    stored = current.read()
    if spec.staging_schema is not None:
        business = T.StructType([f for f in spec.staging_schema.fields if f.name not in (ROW_NUMBER, DELETE_FLAG)])
        source = conform(source, business).where(F.col(REJECT_COL).isNull())
    given = source.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
    key, width, frames = reconcile.range_key(given, stored, spec.keys, ranges)
    return reconcile.reconcile_ranges(*frames, key, width)


def foreign_key_report(spec: TableSpec, current: SnapshotTable, loaded: dict) -> dict:
    """Orphan counts per declared foreign key (specs run parents first, so
    every parent is current); None where the parent was never loaded."""
    report = {}
    for col, parent, parent_col in spec.foreign_keys:
        report[f"{col}->{parent}.{parent_col}"] = None
        if parent in loaded:
            child = current.read().select(col)
            report[f"{col}->{parent}.{parent_col}"] = orphans(child, loaded[parent].read(), [col], [parent_col]).count()
    return report


__all__ = [
    "ACTION",
    "KEEP",
    "Layout",
    "MergeResult",
    "StageResult",
    "batch_from_staging",
    "bootstrap_tables",
    "build_history",
    "build_history_from_batches",
    "foreign_key_report",
    "merge_table",
    "merge_tables",
    "reconcile_content",
    "run_tables",
    "stage_table",
    "stage_tables",
    "staged_frame",
]
