"""Table specifications: what to load, how, and under which keys.

A ``TableSpec`` replaces a per-table config section. ``load_specs`` accepts
the same nested-dict shape a YAML config parses into; reading the file is
left to the caller (it is a driver-side concern).
"""

from __future__ import annotations

import datetime as dt
import enum
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from lakeloom.functions.types import schema_from_columns

#: Fixed value: the characters that names in source queries may have.
_IDENTIFIER = re.compile(r"[A-Za-z0-9_-]+")


def check_identifier(name: str) -> str:
    """Reject names that could smuggle SQL into generated source queries."""
    if not isinstance(name, str) or not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"invalid identifier {name!r}")
    return name


class LoadMode(str, enum.Enum):
    FULL = "full"
    INCREMENTAL = "incremental"


@dataclass(frozen=True)
class TableSpec:
    """One loadable table.

    ``update_col`` drives the high-water mark; it may be a timestamp (overlap
    is a ``timedelta``) or an integer sequence (overlap is an ``int``).
    ``audit_seq_col`` set means an audit (change) log exists for the table.
    """

    name: str
    keys: tuple[str, ...]
    load_mode: LoadMode = LoadMode.INCREMENTAL
    update_col: str | None = None
    audit_seq_col: str | None = None
    audit_op_col: str = "operation_type"
    audit_time_col: str = "operation_timestamp"
    delete_op: str = "D"
    overlap: dt.timedelta | int = dt.timedelta(days=1)
    staging_schema: T.StructType | None = None
    partition_col: str | None = None
    num_partitions: int = 1
    skip: bool = False
    newer_than_guard: bool = False
    foreign_keys: tuple[tuple[str, str, str], ...] = field(default_factory=tuple)
    staging_path: str | None = None
    current_path: str | None = None
    point_in_time: bool = False
    point_in_time_path: str | None = None
    partition_by_key: bool = False  # read by ranges of the key, if it is one integral column

    def __post_init__(self):
        check_identifier(self.name)
        if not self.keys:
            raise ValueError(f"{self.name}: at least one key column is required")
        for c in (*self.keys, self.update_col, self.audit_seq_col, self.partition_col):
            if c is not None:
                check_identifier(c)

    @property
    def is_full(self) -> bool:
        return self.load_mode == LoadMode.FULL

    @property
    def has_audit(self) -> bool:
        return self.audit_seq_col is not None

    @property
    def sequence_watermark(self) -> bool:
        return isinstance(self.overlap, int)

    def resolved(self, schema: T.StructType) -> TableSpec:
        """This spec for a source of ``schema``: an integral update column makes
        a sequence watermark, an integral key the ranges of a partitioned read."""
        integral = {f.name for f in schema.fields if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
        spec = self
        if spec.update_col in integral and not spec.sequence_watermark:
            spec = replace(spec, overlap=0)
        if spec.partition_by_key and spec.partition_col is None and len(spec.keys) == 1 and spec.keys[0] in integral:
            spec = replace(spec, partition_col=spec.keys[0])
        return spec

    def watermark_floor(self):
        """Value used when nothing has been loaded yet."""
        return 0 if self.sequence_watermark else dt.datetime(1900, 1, 1)


def _mode(value) -> LoadMode:
    if isinstance(value, LoadMode):
        return value
    if isinstance(value, bool):
        return LoadMode.FULL if value else LoadMode.INCREMENTAL
    return LoadMode(str(value).lower())


def _env_path(cfg: dict, section: str, name: str, env: str | None) -> str | None:
    """``<section>.path.<env>`` + table name, or None when absent or empty."""
    paths = (cfg.get(section) or {}).get("path") or {}
    base = paths.get(env) if env is not None and isinstance(paths, dict) else None
    return f"{base}{name}" if base else None


def _schema(cfg: dict, schemas: dict | None) -> T.StructType | None:
    """Declared columns, or the named schema of the staging section."""
    if cfg.get("columns"):
        return schema_from_columns(cfg["columns"])
    name = (cfg.get("staging_table") or {}).get("schema")
    if not name or schemas is None:
        return None
    if name not in schemas:
        raise ValueError(f"unknown schema {name!r}")
    return schema_from_columns(schemas[name])


def load_specs(config: dict, env: str | None = None, schemas: dict | None = None) -> list[TableSpec]:
    """Build ordered specs from a config dict ``{table: {...}}``.

    Recognised keys per table: ``primary_keys``, ``full_load_table`` or
    ``load_mode``, ``update_timestamp_col``, ``audit_seq_id``, ``skip``,
    ``partition_key``, ``num_partition``, ``overlap_days`` / ``overlap_seq``,
    ``columns`` ([name, type, nullable] triples), ``foreign_keys``
    ([column, parent_table, parent_column] triples), ``point_in_time``,
    ``newer_than_guard``, ``delete_op``, ``audit_op_col``, ``audit_time_col``.
    ``schemas`` maps the names that ``staging_table.schema`` may give to column
    triples or types. The partition key ``row_number`` means ranges of an
    integral key. With
    ``env``, the ``staging_table`` / ``business_current_table`` /
    ``point_in_time_table`` sections' ``path.<env>`` plus the table name give
    the table locations (any Hadoop file system URI). Tables with foreign keys
    are ordered after their parents so parent checks can run first.
    """
    specs = []
    for name, cfg in config.items():
        mode = _mode(cfg.get("load_mode", cfg.get("full_load_table", False)))
        if "overlap_seq" in cfg:
            overlap = int(cfg["overlap_seq"])
        else:
            overlap = dt.timedelta(days=float(cfg.get("overlap_days", 1)))
        audit = cfg.get("audit_seq_id")
        part = cfg.get("partition_key")
        specs.append(
            TableSpec(
                name=name,
                keys=tuple(cfg["primary_keys"]),
                load_mode=mode,
                update_col=cfg.get("update_timestamp_col") or None,
                audit_seq_col=None if audit in (None, "", "NA") else audit,
                overlap=overlap,
                staging_schema=_schema(cfg, schemas),
                partition_by_key=part == "row_number",
                newer_than_guard=bool(cfg.get("newer_than_guard", False)),
                **{k: cfg[k] for k in ("delete_op", "audit_op_col", "audit_time_col") if cfg.get(k)},
                partition_col=None if part in (None, "", "row_number") else part,
                num_partitions=int(cfg.get("num_partition", 1)),
                skip=bool(cfg.get("skip", False)),
                foreign_keys=tuple(tuple(fk) for fk in cfg.get("foreign_keys", ())),
                staging_path=_env_path(cfg, "staging_table", name, env),
                current_path=_env_path(cfg, "business_current_table", name, env),
                point_in_time=bool(cfg.get("point_in_time", False)),
                point_in_time_path=_env_path(cfg, "point_in_time_table", name, env),
            )
        )
    return order_specs(specs)


def order_specs(specs: list[TableSpec]) -> list[TableSpec]:
    """Parents before children (stable otherwise)."""
    by_name = {s.name: s for s in specs}
    done: list[TableSpec] = []
    seen: set[str] = set()

    def visit(s: TableSpec, stack=()):
        if s.name in seen:
            return
        if s.name in stack:
            raise ValueError(f"foreign-key cycle through {s.name}")
        for _, parent, _ in s.foreign_keys:
            if parent in by_name:
                visit(by_name[parent], (*stack, s.name))
        seen.add(s.name)
        done.append(s)

    for s in specs:
        visit(s)
    return done
