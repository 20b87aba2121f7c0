"""lakeloom: keyed, reconciled table loading on Spark.

Every operator takes and returns DataFrames; planning and execution are
left to Catalyst. Sub-packages:

* ``sources``   JDBC options and population reads, CSV ingest, versioned
                snapshot tables (optionally bucketed by key)
* ``operators`` extraction, numbering, change capture, staging, merge,
                checks, point-in-time history
* ``functions`` column-expression builders (key match, change predicate,
                typed literals, type names)
* ``plans``     read plans, size-checked broadcast, control table,
                pipeline jobs, sizing, work directories
* ``streaming`` change-log replay through Structured Streaming
* ``jobs``      command line: bootstrap / stage / merge / run
"""

from lakeloom.operators.changes import apply_change_log, change_log, latest_deleted_keys, latest_per_key, snapshot_changes
from lakeloom.operators.checks import CheckFailed, duplicate_keys, null_counts, orphans, require_keys_valid
from lakeloom.operators.extract import extract, extract_full, extract_incremental, high_water_mark
from lakeloom.operators.history import as_of, scd2
from lakeloom.operators.merge import merge, merge_actions
from lakeloom.operators.numbering import number_rows
from lakeloom.operators.staging import cast_rejects, conform, conform_schema, stage_batch
from lakeloom.plans.control import ControlTable, pending_versions
from lakeloom.plans.pipeline import Layout, bootstrap_tables, merge_table, merge_tables, run_tables, stage_table, stage_tables
from lakeloom.sources.snapshots import SnapshotTable
from lakeloom.spec import LoadMode, TableSpec, load_specs

__all__ = [
    "CheckFailed",
    "ControlTable",
    "Layout",
    "LoadMode",
    "SnapshotTable",
    "TableSpec",
    "apply_change_log",
    "as_of",
    "bootstrap_tables",
    "cast_rejects",
    "change_log",
    "conform",
    "conform_schema",
    "duplicate_keys",
    "extract",
    "extract_full",
    "extract_incremental",
    "high_water_mark",
    "latest_deleted_keys",
    "latest_per_key",
    "load_specs",
    "merge",
    "merge_actions",
    "merge_table",
    "merge_tables",
    "null_counts",
    "number_rows",
    "orphans",
    "pending_versions",
    "require_keys_valid",
    "run_tables",
    "scd2",
    "snapshot_changes",
    "stage_batch",
    "stage_table",
    "stage_tables",
]
