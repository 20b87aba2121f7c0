"""Keyed merges into a current-state table, expressed as joins.

``merge_actions`` labels every row of the would-be result with an action:

============  =========================================================
keep          target row whose key is absent from the batch (incremental)
unchanged     key in both, no non-key column differs (NULL = NULL)
update        key in both, some non-key column differs
insert        key only in the batch, live row
delete        key in both and the batch row is a tombstone (incremental),
              or key absent from the batch (full)
ignore        tombstone for a key the target does not have
============  =========================================================

Delete wins over update, and a full load ignores tombstones (absent keys are
deleted anyway), but keeps the stored rows of keys named in ``protected``:
those whose batch row was rejected. Rows labelled keep / unchanged / update / insert form the new
table; the label column also feeds the count reconciliation.

Three physical forms give the same rows:

* ``full_outer``: one full-outer join (both sides shuffled on the keys).
* ``broadcast``: for a small batch. The target is never shuffled: it is
  scanned once against the broadcast batch (left outer), and its key column
  once more against the broadcast batch keys to find which batch keys it has.
  Used only after the batch's rows and bytes were measured, also when asked
  for explicitly (a warning tells when the shuffle form runs instead).
  Full loads always use the shuffle form.
* ``bloom``: for a batch too large to broadcast but small against the target.
  A Bloom filter over the batch keys (sized from their measured number, itself
  broadcast within a checked size) tells which target rows the batch can
  touch; only those are shuffled to the full-outer join, all others are kept
  where they are scanned.

Preconditions (checked by the pipeline with ``checks.require_keys_valid``):
batch keys are unique and not NULL; target keys are unique.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.keys import changed, key_match
from lakeloom.operators.bloom import filter_bytes, key_filter, with_may_contain
from lakeloom.plans.broadcast import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS, check_size, fits

ACTION = "_merge_action"
KEEP, UNCHANGED, UPDATE, INSERT, DELETE, IGNORE = "keep", "unchanged", "update", "insert", "delete", "ignore"
ACTIONS = (KEEP, UNCHANGED, UPDATE, INSERT, DELETE, IGNORE)
WRITTEN = (KEEP, UNCHANGED, UPDATE, INSERT)

#: A filter pays if the target has so many times the batch's rows.
BLOOM_SHARE = 8

_T, _S = "t__", "s__"
_PRESENT, _PROTECTED, _MAY = "_present", "_protected", "_may_match"


def _side(df: DataFrame, cols, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols], F.lit(True).alias(prefix + _PRESENT))


def _action(mode: str, has_delete: bool, delete_col: str, compare, newer_col: str | None) -> Column:
    t_in = F.col(_T + _PRESENT).isNotNull()
    s_in = F.col(_S + _PRESENT).isNotNull()
    tomb = F.coalesce(F.col(_S + delete_col), F.lit(False)) if has_delete else F.lit(False)
    diff = changed(compare, _S, _T)
    if newer_col is not None:
        # Optional guard: an older staged row never overwrites or deletes a newer
        # target row. A NULL on either side is neither older nor newer.
        stale = F.coalesce(F.col(_S + newer_col) < F.col(_T + newer_col), F.lit(False))
        diff, live_delete = diff & ~stale, tomb & ~stale
    else:
        live_delete = tomb
    if mode == "full":
        kept = F.coalesce(F.col(_S + _PROTECTED), F.lit(False))
        return (
            F.when(~s_in, F.lit(DELETE))
            .when(kept, F.when(t_in, F.lit(KEEP)).otherwise(F.lit(IGNORE)))
            .when(~t_in, F.lit(INSERT))
            .when(diff, F.lit(UPDATE))
            .otherwise(F.lit(UNCHANGED))
        )
    return (
        F.when(~s_in, F.lit(KEEP))
        .when(~t_in, F.when(tomb, F.lit(IGNORE)).otherwise(F.lit(INSERT)))
        .when(live_delete, F.lit(DELETE))
        .when(tomb, F.lit(UNCHANGED))
        .when(diff, F.lit(UPDATE))
        .otherwise(F.lit(UNCHANGED))
    )


def _project(joined: DataFrame, cols, action: Column) -> DataFrame:
    a = joined.withColumn(ACTION, action)
    from_source = F.col(ACTION).isin(INSERT, UPDATE, IGNORE)  # ignore: only the batch side exists
    return a.select(
        *[F.when(from_source, F.col(_S + c)).otherwise(F.col(_T + c)).alias(c) for c in cols],
        F.col(ACTION),
    )


def choose_strategy(
    source: DataFrame, mode: str, strategy: str, max_rows: int, max_bytes: int, measured: tuple[int, int] | None = None, target_rows: int | None = None
) -> str:
    """``full_outer``, ``broadcast`` or ``bloom``. A broadcast (asked for or automatic) is
    used only when the batch is small by ``measured`` (rows and bytes, e.g. of
    the staging commits) or else by a measuring pass. Beyond the bound the
    batch's key filter is used if the target is known to have ``BLOOM_SHARE``
    times as many rows, else the shuffle join."""
    if strategy not in ("auto", "full_outer", "broadcast", "bloom"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    if strategy == "full_outer" or mode == "full":
        return "full_outer"
    if strategy == "bloom":
        return "bloom"
    if measured is None:
        size = check_size(source, max_rows, max_bytes)
        measured = size.rows, size.bytes
    if fits(*measured, max_rows, max_bytes):
        return "broadcast"
    if strategy == "broadcast":
        warnings.warn("the batch is too large to broadcast: merging by a shuffle join", stacklevel=2)
    return "bloom" if target_rows is not None and target_rows >= BLOOM_SHARE * measured[0] else "full_outer"


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    keys,
    mode: str = "incremental",
    delete_col: str = "is_deleted",
    compare_cols=None,
    newer_col: str | None = None,
    strategy: str = "auto",
    max_broadcast_rows: int = DEFAULT_MAX_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BYTES,
    protected: DataFrame | None = None,
    decided: bool = False,
    batch_rows: int | None = None,
) -> DataFrame:
    """Target columns plus ``_merge_action`` for every target and batch row.
    ``decided``: ``strategy`` is the outcome of :func:`choose_strategy`;
    ``batch_rows``: the number of batch rows, where it is known."""
    keys = list(keys)
    mode = getattr(mode, "value", mode)
    cols = list(target.columns)
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"batch lacks target columns {missing}")
    non_keys = [c for c in cols if c not in keys]
    compare = list(compare_cols) if compare_cols is not None else non_keys
    has_delete = delete_col in source.columns
    if mode == "full" and has_delete:
        source = source.where(~F.coalesce(F.col(delete_col), F.lit(False)))
    s_cols = cols + ([delete_col] if has_delete else [])

    t = _side(target, cols, _T)
    s = _side(source, s_cols, _S)
    if mode == "full":
        s = s.withColumn(_S + _PROTECTED, F.lit(False))
        if protected is not None:
            only = protected.select(*keys).distinct().join(source.select(*keys), keys, "left_anti")
            s = s.unionByName(_side(only, keys, _S).withColumn(_S + _PROTECTED, F.lit(True)), allowMissingColumns=True)
    cond = key_match(keys, _T, _S)
    action = _action(mode, has_delete, delete_col, compare, newer_col)
    plan = strategy if decided else choose_strategy(source, mode, strategy, max_broadcast_rows, max_broadcast_bytes)

    if plan == "bloom":
        n_keys = source.count() if batch_rows is None else batch_rows
        if filter_bytes(n_keys) <= max_broadcast_bytes:
            # Hashes go by type: the batch's keys are hashed as the target's.
            typed = source.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys])
            blocks = key_filter(typed, keys, n_keys)
            marked = with_may_contain(target, keys, blocks, n_keys, _MAY)
            untouched = marked.where(~F.col(_MAY)).select(*cols, F.lit(KEEP).alias(ACTION))
            t = _side(marked.where(_MAY), cols, _T)
            return untouched.unionByName(_project(t.join(s, cond, "full_outer"), cols, action))
        warnings.warn("the batch has too many keys for a filter: merging by a shuffle join", stacklevel=2)
        plan = "full_outer"

    if plan == "full_outer":
        return _project(t.join(s, cond, "full_outer"), cols, action)

    # Broadcast split (incremental only): the batch is small and proven so.
    touched = t.join(F.broadcast(s), cond, "left_outer")
    batch_keys = F.broadcast(source.select(*[F.col(k).alias(_S + k) for k in keys]))
    matched = target.select(*[F.col(k).alias(_T + k) for k in keys]).join(batch_keys, cond, "left_semi")
    fresh = s.join(F.broadcast(matched), cond, "left_anti")
    fresh = fresh.select(
        *[F.lit(None).cast(target.schema[c].dataType).alias(_T + c) for c in cols],
        F.lit(None).cast("boolean").alias(_T + _PRESENT),
        *[F.col(_S + c) for c in s_cols],
        F.col(_S + _PRESENT),
    )
    return _project(touched.unionByName(fresh), cols, action)


def initial_actions(source: DataFrame, columns, delete_col: str = "is_deleted") -> DataFrame:
    """Actions for a merge into a target known (from metadata) to be empty:
    live rows are inserts, tombstones are ignored. No join is needed."""
    action = F.lit(INSERT)
    if delete_col in source.columns:
        action = F.when(F.coalesce(F.col(delete_col), F.lit(False)), F.lit(IGNORE)).otherwise(F.lit(INSERT))
    return source.select(*[F.col(c) for c in columns], action.alias(ACTION))


def merged_rows(actions: DataFrame) -> DataFrame:
    """The new table content: rows whose action keeps them."""
    return actions.where(F.col(ACTION).isin(*WRITTEN)).drop(ACTION)


def merge(target: DataFrame, source: DataFrame, keys, mode: str = "incremental", **kw) -> DataFrame:
    """Merged table (keyed upsert with deletes) as a DataFrame."""
    return merged_rows(merge_actions(target, source, keys, mode, **kw))


def action_metrics():
    """One count per merge action (observed on the write)."""
    return [F.count(F.when(F.col(ACTION) == a, 1)).alias(a) for a in ACTIONS]


def expected_count(actions: DataFrame) -> DataFrame:
    """Reconciliation figure: target rows + inserts - deletes (one aggregation pass)."""
    target_rows = F.count(F.when(F.col(ACTION).isin(KEEP, UNCHANGED, UPDATE, DELETE), 1))
    inserts = F.count(F.when(F.col(ACTION) == INSERT, 1))
    deletes = F.count(F.when(F.col(ACTION) == DELETE, 1))
    return actions.agg((target_rows + inserts - deletes).alias("expected"))


# --- the individual sets, as the original loader computed them for its counts ---


def insert_keys(target: DataFrame, source: DataFrame, keys, delete_col: str = "is_deleted") -> DataFrame:
    """Live batch keys the target does not have (``left_anti``)."""
    live = source.where(~F.coalesce(F.col(delete_col), F.lit(False))) if delete_col in source.columns else source
    return live.select(*keys).join(target.select(*keys), list(keys), "left_anti")


def delete_keys(target: DataFrame, source: DataFrame, keys, delete_col: str = "is_deleted") -> DataFrame:
    """Tombstoned batch keys the target has (``left_semi`` on a keyed-unique batch)."""
    tomb = source.where(F.coalesce(F.col(delete_col), F.lit(False)))
    return tomb.select(*keys).join(target.select(*keys), list(keys), "left_semi")


def changed_keys(target: DataFrame, source: DataFrame, keys, compare_cols=None) -> DataFrame:
    """Keys present on both sides whose compared columns differ (null-safe)."""
    keys = list(keys)
    compare = list(compare_cols) if compare_cols is not None else [c for c in target.columns if c not in keys]
    t = target.select(*[F.col(c).alias(_T + c) for c in keys + compare])
    s = source.select(*[F.col(c).alias(_S + c) for c in keys + compare])
    j = s.join(t, key_match(keys, _T, _S), "inner").where(changed(compare, _S, _T))
    return j.select(*[F.col(_S + k).alias(k) for k in keys])
