"""JDBC sources: options, subquery scans and partitioned reads.

Filters and column selections applied to the returned DataFrame are pushed
into the database query by Spark's JDBC source, so the population predicates
in ``operators.extract`` work unchanged on a JDBC frame. Credentials come
from environment variables named by the caller, never from files.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from lakeloom.functions.literals import lit_like
from lakeloom.operators.extract import extract, lower_bound
from lakeloom.plans.read_plan import KeyRange, ReadPlan, balanced_ranges, plan_read
from lakeloom.spec import check_identifier


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str | None = None
    user_env: str | None = None
    password_env: str | None = None
    properties: dict = field(default_factory=dict)

    def credentials(self) -> dict:
        out = {}
        if self.user_env:
            out["user"] = os.environ[self.user_env]
        if self.password_env:
            out["password"] = os.environ[self.password_env]
        return out


def table_ref(schema: str | None, table: str) -> str:
    """A validated ``schema.table`` reference."""
    check_identifier(table)
    if schema:
        return f"{check_identifier(schema)}.{table}"
    return table


def subquery(sql: str, alias: str = "src") -> str:
    """Wrap a query for the ``dbtable`` option: ``(sql) alias``."""
    return f"({sql}) {check_identifier(alias)}"


def jdbc_options(source: JdbcSource, dbtable: str, plan: ReadPlan | None = None, fetch_size: int = 10_000) -> dict:
    """Reader options; partition options only when the plan has a real column
    and more than one partition."""
    opts = {
        "url": source.url,
        "dbtable": dbtable,
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "preferTimestampNTZ": "true",
    }
    if source.driver:
        opts["driver"] = source.driver
    opts.update({k: str(v) for k, v in source.properties.items()})
    if plan is not None and plan.partitioned:
        opts.update(
            partitionColumn=plan.column,
            lowerBound=str(plan.lower),
            upperBound=str(plan.upper),
            numPartitions=str(plan.num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, source: JdbcSource, dbtable: str, plan: ReadPlan | None = None, reader=None) -> DataFrame:
    """Scan a table or ``(subquery) alias``; partitioned when ``plan`` says so."""
    opts = jdbc_options(source, dbtable, plan)
    opts.update(source.credentials())
    r = reader if reader is not None else spark.read
    return r.format("jdbc").options(**opts).load()


def read_jdbc_ranges(spark: SparkSession, source: JdbcSource, dbtable: str, column: str, ranges: list[KeyRange], reader=None) -> DataFrame:
    """Scan a table with one partition for each of ``ranges`` (:func:`balanced_ranges`):
    partitions of about equal rows, however the key is distributed."""
    check_identifier(column)
    opts = jdbc_options(source, dbtable)
    opts.update(source.credentials())
    url, table = opts.pop("url"), opts.pop("dbtable")
    r = reader if reader is not None else spark.read
    return r.jdbc(url=url, table=table, predicates=[x.predicate(column) for x in ranges], properties=opts)


def read_population(
    spark: SparkSession,
    source: JdbcSource,
    spec,
    hwm,
    run_ts,
    schema_name: str | None = None,
    rows_per_partition: int | None = None,
    reader_factory=None,
    balanced: bool = False,
) -> tuple[DataFrame, ReadPlan]:
    """The extraction population of ``spec`` read over JDBC.

    1. Bounds: ``min``/``max``/``count`` of the partition column over the
       filtered population, one aggregate pushed to the database.
    2. Scan: the same table with partition options from those bounds; the
       population predicate is a DataFrame filter, pushed into every
       partition's query.
    With ``balanced`` the partitions get equal numbers of rows instead of equal
    widths: one more scan, of the partition column alone, finds their ranges.
    Without a partition column the scan is a single partition.
    """
    dbtable = table_ref(schema_name, spec.name)

    def scan(plan=None):
        r = reader_factory() if reader_factory is not None else None
        return read_jdbc(spark, source, dbtable, plan, reader=r)

    plan = None
    if spec.partition_by_key and spec.partition_col is None:
        spec = spec.resolved(scan().schema)
    if spec.partition_col:
        plan = plan_read(extract(scan(), spec, hwm, run_ts), spec.partition_col, spec.num_partitions, rows_per_partition)
    if balanced and plan is not None and plan.partitioned:
        ranges = balanced_ranges(extract(scan(plan), spec, hwm, run_ts), spec.partition_col, plan.num_partitions)
        df = read_jdbc_ranges(spark, source, dbtable, spec.partition_col, ranges, reader=reader_factory() if reader_factory is not None else None)
        return extract(df, spec, hwm, run_ts), plan
    return extract(scan(plan), spec, hwm, run_ts), plan


def read_audit(spark: SparkSession, source: JdbcSource, spec, hwm, schema_name: str | None = None, reader_factory=None) -> DataFrame:
    """The audit log of ``spec`` over JDBC: by ranges of its sequence when the
    table asks for several partitions, and only from the watermark on where
    nothing needs older entries."""
    dbtable = table_ref(schema_name, f"{spec.name}_audit")

    def scan(plan=None):
        df = read_jdbc(spark, source, dbtable, plan, reader=reader_factory() if reader_factory is not None else None)
        if spec.point_in_time or spec.sequence_watermark or spec.audit_time_col not in df.columns:
            return df
        return df.where(F.col(spec.audit_time_col) >= lit_like(lower_bound(hwm, spec.overlap), df, spec.audit_time_col))

    if spec.num_partitions <= 1:
        return scan()
    return scan(plan_read(scan(), spec.audit_seq_col, spec.num_partitions))
