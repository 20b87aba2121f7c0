"""Loading tables side by side.

Tables depend on each other by foreign keys only. Levels of that order are run
one after the other; the tables of a level run as parallel jobs of one
application, each in a scheduler pool of its own, so that a small dimension
does not wait behind a large fact. A table that fails stops its children, and
theirs, and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

from lakeloom.plans.pipeline import Layout, merge_tables, stage_tables
from lakeloom.spec import TableSpec, order_specs

_POOL = "spark.scheduler.pool"


class LoadFailed(Exception):
    """Some tables were not loaded: ``failed`` (table to exception), ``stopped``
    (table to the parent it waited for); ``done`` has the results of the others."""

    def __init__(self, done: dict, failed: dict, stopped: dict):
        self.done, self.failed, self.stopped = done, failed, stopped
        super().__init__(f"failed: { {k: str(v) for k, v in failed.items()} }, stopped: {stopped}, done: {sorted(done)}")


@dataclass
class _Outcome:
    done: dict = field(default_factory=dict)
    failed: dict = field(default_factory=dict)
    stopped: dict = field(default_factory=dict)


def dependency_levels(specs: list[TableSpec]) -> list[list[TableSpec]]:
    """Tables by the longest chain of parents (among ``specs``) above them; a cycle is an error."""
    level: dict[str, int] = {}
    names = {s.name for s in specs}
    for s in order_specs(list(specs)):
        level[s.name] = 1 + max((level[p] for _, p, _ in s.foreign_keys if p in names and p != s.name), default=-1)
    return [[s for s in specs if level[s.name] == k] for k in range(max(level.values(), default=-1) + 1)]


def run_levels(spark: SparkSession, specs, job: Callable[[TableSpec], object], max_parallel: int = 4) -> dict:
    """``{table: job(spec)}`` for every table that is not skipped. Raises
    :class:`LoadFailed` once all that could run has run."""
    out = _Outcome()
    sc = spark.sparkContext

    def run(spec: TableSpec):
        sc.setLocalProperty(_POOL, f"load-{spec.name}")
        try:
            return job(spec)
        finally:
            sc.setLocalProperty(_POOL, None)

    for level in dependency_levels([s for s in specs if not s.skip]):
        with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as threads:
            started = {}
            for spec in level:
                blocked = next((p for _, p, _ in spec.foreign_keys if p in out.failed or p in out.stopped), None)
                if blocked is not None:
                    out.stopped[spec.name] = blocked
                else:
                    started[spec.name] = threads.submit(inheritable_thread_target(spark)(run), spec)
            for name, future in started.items():
                try:
                    out.done[name] = future.result()
                except Exception as e:  # reported with the rest
                    out.failed[name] = e
    if out.failed:
        raise LoadFailed(out.done, out.failed, out.stopped)
    return out.done


def load_tables(
    spark: SparkSession, specs, sources: dict, audits: dict, root: str, run_ts, strategy: str = "auto", buckets: int | None = None,
    keep_versions: int | None = None, bucket_width: int | None = None, max_parallel: int = 4,
) -> dict:
    """``pipeline.run_tables`` with independent tables side by side:
    ``{table: (StageResult, MergeResult, fk_report)}``."""
    layout = Layout(root, buckets, bucket_width)

    def load(spec: TableSpec):
        staged = stage_tables(spark, [spec], sources, audits, layout, run_ts)
        merged = merge_tables(spark, [spec], layout, run_ts, strategy, audits, keep_versions, related=specs)
        return (staged[spec.name], *merged[spec.name])

    return run_levels(spark, specs, load, max_parallel)
