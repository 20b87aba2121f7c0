"""Command-line jobs: bootstrap, stage, merge (and both in one run).

    spark-submit --py-files lakeloom.zip lakeloom/jobs.py stage --tables load.yaml \
        --env dev --run-date 20251120 --root s3a://bucket/lake --parquet-dir s3a://bucket/src

Sources are either parquet directories (``<dir>/<table>`` or
``<dir>/<table>.parquet``) or a JDBC database (``--jdbc-url``, credentials
from the environment variables named by ``--user-env`` / ``--password-env``).
A table's audit log is ``<table>_audit`` in the same source, when the table
declares an audit sequence. ``--run-date`` is a day (``yyyymmdd``, midnight)
or an ISO timestamp.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from lakeloom.plans import pipeline
from lakeloom.plans.workspace import path_exists
from lakeloom.sources.jdbc import JdbcSource, read_audit, read_jdbc, read_population, table_ref
from lakeloom.spec import load_specs


def parse_run_date(text: str) -> dt.datetime:
    if len(text) == 8 and text.isdigit():
        return dt.datetime.strptime(text, "%Y%m%d")
    return dt.datetime.fromisoformat(text)


def read_config(path: str) -> dict:
    """JSON, or YAML when PyYAML is installed."""
    with open(path) as fh:
        text = fh.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover
            raise SystemExit("YAML config needs PyYAML; pass JSON instead") from e
        return yaml.safe_load(text)
    return json.loads(text)


def _parquet_source(spark, base: str, name: str):
    for candidate in (f"{base}/{name}", f"{base}/{name}.parquet"):
        if path_exists(spark, candidate):
            return spark.read.parquet(candidate)
    return None


def load_sources(spark, specs, args, control=None, plans=None):
    """``(sources, audits)`` frames per table for the chosen source kind.
    For JDBC, ``plans`` (a dict) receives each table's read plan, whose
    ``row_count`` is the source's own count of the population."""
    sources, audits = {}, {}
    plans = plans if plans is not None else {}
    if args.jdbc_url:
        src = JdbcSource(args.jdbc_url, driver=args.jdbc_driver, user_env=args.user_env, password_env=args.password_env)
        for spec in specs:
            if spec.skip:
                continue
            # The watermark's kind follows from the column's type in the source.
            spec = spec.resolved(read_jdbc(spark, src, table_ref(args.db_schema, spec.name)).schema)
            hwm = control.high_water_mark(spec.name, spec.watermark_floor()) if control else spec.watermark_floor()
            sources[spec.name], plans[spec.name] = read_population(spark, src, spec, hwm, args.run_ts, schema_name=args.db_schema)
            if spec.has_audit:
                audits[spec.name] = read_audit(spark, src, spec, hwm, schema_name=args.db_schema)
        return sources, audits
    for spec in specs:
        if spec.skip:
            continue
        df = _parquet_source(spark, args.parquet_dir, spec.name)
        if df is None:
            raise SystemExit(f"no source for {spec.name} under {args.parquet_dir}")
        sources[spec.name] = df
        if spec.has_audit:
            audit = _parquet_source(spark, args.parquet_dir, f"{spec.name}_audit")
            if audit is not None:
                audits[spec.name] = audit
    return sources, audits


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="lakeloom.jobs")
    p.add_argument("job", choices=["bootstrap", "stage", "merge", "run"])
    p.add_argument("--tables", required=True, help="table config (JSON or YAML)")
    p.add_argument("--env", default=None)
    p.add_argument("--schemas", default=None, help="named schemas (JSON or YAML): {name: [[column, type, nullable], ...]}")
    p.add_argument("--root", required=True, help="base URI for tables without configured paths, and the control table")
    p.add_argument("--run-date", default=None)
    p.add_argument("--parquet-dir", default=None)
    p.add_argument("--jdbc-url", default=None)
    p.add_argument("--jdbc-driver", default=None)
    p.add_argument("--db-schema", default=None)
    p.add_argument("--user-env", default=None)
    p.add_argument("--password-env", default=None)
    p.add_argument("--strategy", default="auto", choices=["auto", "full_outer", "broadcast", "bloom"])
    p.add_argument("--buckets", type=int, default=None, help="hash buckets for current tables (0: none; default: by the size of what is staged first)")
    p.add_argument("--bucket-width", type=int, default=None, help="range buckets (key width) for single integral keys")
    p.add_argument("--keep-versions", type=int, default=None, help="vacuum data older than this many commits")
    p.add_argument("--only", nargs="*", default=None, help="restrict to these tables")
    args = p.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    specs = load_specs(read_config(args.tables), env=args.env, schemas=read_config(args.schemas) if args.schemas else None)
    if args.only:
        specs = [s for s in specs if s.name in set(args.only)]
    layout = pipeline.Layout(args.root, args.buckets, args.bucket_width)
    report = {}
    if args.job == "bootstrap":
        report = pipeline.bootstrap_tables(spark, specs, layout)
    else:
        if args.run_date is None:
            raise SystemExit("--run-date is required")
        args.run_ts = parse_run_date(args.run_date)
        audits = {}
        if args.job in ("stage", "run"):
            if not (args.parquet_dir or args.jdbc_url):
                raise SystemExit("give --parquet-dir or --jdbc-url")
            plans = {}
            sources, audits = load_sources(spark, specs, args, layout.control(spark), plans)
            staged = pipeline.stage_tables(spark, specs, sources, audits, layout, args.run_ts)
            report["stage"] = {}
            for k, v in staged.items():
                entry = {"version": v.version, "rows": v.rows, "tombstones": v.tombstones, "rejects": v.rejects}
                plan = plans.get(k)
                if plan is not None:
                    # the source's count at planning time vs live rows staged: a
                    # difference means the source moved between the two reads
                    entry["source_rows"] = plan.row_count
                    entry["source_drift"] = (v.rows - v.tombstones) - plan.row_count
                report["stage"][k] = entry
        if args.job in ("merge", "run"):
            if args.job == "merge" and any(s.point_in_time and s.has_audit and not s.skip for s in specs):
                if not (args.parquet_dir or args.jdbc_url):
                    raise SystemExit("point-in-time tables need their audit logs: give --parquet-dir or --jdbc-url")
                _, audits = load_sources(spark, specs, args, layout.control(spark))
            merged = pipeline.merge_tables(spark, specs, layout, args.run_ts, args.strategy, audits, args.keep_versions)
            report["merge"] = {k: {"version": m.version, "strategy": m.strategy, "actions": m.actions, "orphans": fk} for k, (m, fk) in merged.items()}
    print(json.dumps(report, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
