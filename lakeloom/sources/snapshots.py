"""Versioned snapshot tables on any Hadoop file system (parquet).

Layout::

    <path>/v=<n>/                 data written by commit n (parquet)
    <path>/v=<n>/_bucket=<b>/     ... or, for a bucketed table, one directory per bucket
    <path>/_log/<n, 20 digits>.json
                                  one small document per commit: version, data_version,
                                  operation, rows, written_at, schema, manifest

A commit writes its data first and its log document after; readers take the
highest commit in the log, so a half-written data directory is never served.
``stage_write`` and ``publish`` are the two halves: what lies between them can
check the written data, and data that fails is never served at all.
If a writer was lost between the two, the next attempt writes a fresh sibling
directory (``v=<n>-<id>``) and its commit names it; the orphan stays unread.
Log documents are created with overwrite disabled, so a second writer racing
for the same version fails instead of replacing a commit. ``restore`` is a
commit pointing at an older commit's data (nothing is copied). This is a
loading convention for a single writer per table, not a transaction log;
where Delta or Iceberg is installed, point these calls at it.

Bucketed tables (``bucket_keys`` + ``buckets``) place each row in
``pmod(hash(keys), buckets)``. A commit's ``manifest`` maps every non-empty
bucket to ``[data_version, rows]``; a write may replace only some buckets and
carry the others forward by reference. That is what lets an incremental merge
rewrite the buckets its batch touches instead of the whole table. Each commit
records its layout (keys, buckets, width); a table opened with another layout
is read whole and rewritten whole, never by its buckets.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans.metrics import observed_values
from lakeloom.plans.workspace import delete_path, empty_frame, list_dirs, list_files, path_exists, read_text, write_text

BUCKET = "_bucket"
#: The write task of a bucket.
SLOT = "_slot"
#: Up to so many replaced buckets are numbered one by one; more share tasks by remainder.
LISTED_BUCKETS = 2000

LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("data_version", T.LongType(), False),
        T.StructField("operation", T.StringType(), False),
        T.StructField("rows", T.LongType(), True),
        T.StructField("written_at", T.TimestampNTZType(), False),
    ]
)


@dataclass(frozen=True)
class Commit:
    version: int
    data_version: int
    operation: str
    rows: int | None
    written_at: str = ""
    schema: str | None = None
    manifest: dict | None = field(default=None)  # bucketed tables: {"b": [data_version, rows, data_dir]}
    data_dir: str | None = None  # directory of data_version, when not the default "v=<n>"
    layout: dict | None = None  # bucketed tables: keys, buckets, width
    source_version: int | None = None  # the last version of its source that the table holds
    bytes: int | None = None  # of its values, where measured


def bucket_of(keys, buckets: int) -> Column:
    """Bucket id of a row: the same Murmur3 hash Spark uses for hash partitioning."""
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets))


def range_bucket_of(key: str, width: int) -> Column:
    """Bucket id by key range: ``floor(key / width)`` for an integral key."""
    k = f"CAST(`{key}` AS BIGINT)"
    return F.expr(f"({k} - pmod({k}, {int(width)})) div {int(width)}")


class SnapshotTable:
    """A versioned table. ``bucket_keys`` + ``buckets`` hash-bucket rows by key;
    ``bucket_keys`` (one integral key) + ``bucket_width`` range-buckets them
    instead, which suits append-mostly tables keyed by a growing sequence:
    new keys land in the newest buckets, so a batch rewrites few of them."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        bucket_keys=None,
        buckets: int = 0,
        max_records_per_file: int | None = None,
        bucket_width: int | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket_keys = tuple(bucket_keys) if bucket_keys else None
        self.buckets = int(buckets) if bucket_keys else 0
        self.bucket_width = int(bucket_width) if bucket_keys and bucket_width else None
        if self.bucket_width and len(self.bucket_keys) != 1:
            raise ValueError("range buckets need exactly one integral key")
        self.max_records_per_file = max_records_per_file  # splits large buckets into several files

    @property
    def bucketed(self) -> bool:
        return self.buckets > 0 or self.bucket_width is not None

    def bucket_expr(self) -> Column:
        """The bucket id of a row of this table (hash or key range)."""
        if self.bucket_width is not None:
            return range_bucket_of(self.bucket_keys[0], self.bucket_width)
        return bucket_of(self.bucket_keys, self.buckets)

    @property
    def layout(self) -> dict | None:
        if not self.bucketed:
            return None
        return {"keys": list(self.bucket_keys), "buckets": self.buckets, "width": self.bucket_width}

    def same_layout(self, commit: Commit | None) -> bool:
        """Whether ``commit`` is bucketed as this table was opened."""
        return commit is not None and commit.manifest is not None and commit.layout == self.layout

    def _require_layout(self, commit: Commit | None) -> None:
        if not self.same_layout(commit):
            stored = commit.layout if commit is not None else None
            raise ValueError(f"{self.path}: opened with layout {self.layout}, stored with {stored}; rewrite it whole")

    def touched_buckets(self, batch: DataFrame) -> list[int]:
        """Distinct bucket ids of ``batch`` (at most one per bucket reaches the driver)."""
        self._require_layout(self.current())
        return sorted(r["b"] for r in batch.select(self.bucket_expr().alias("b")).distinct().collect())

    # --- paths and log -------------------------------------------------
    @property
    def log_path(self) -> str:
        return f"{self.path}/_log"

    def data_path(self, data_version: int, data_dir: str | None = None) -> str:
        return f"{self.path}/{data_dir or f'v={data_version}'}"

    def _fresh_data_path(self, version: int) -> tuple[str, str]:
        """``v=<n>``, or a new sibling when an earlier attempt at version n left
        data without committing it (a driver lost between data and commit)."""
        name = f"v={version}"
        if path_exists(self.spark, self.data_path(version)):
            name = f"v={version}-{uuid.uuid4().hex[:8]}"
        return self.data_path(version, name), name

    @staticmethod
    def _entry_dir(entry) -> str:
        return entry[2] if len(entry) > 2 and entry[2] else f"v={entry[0]}"

    def _log_names(self) -> list[str]:
        return [n for n in list_files(self.spark, self.log_path) if n.endswith(".json")]

    def _load(self, name: str) -> Commit:
        return Commit(**json.loads(read_text(self.spark, f"{self.log_path}/{name}")))

    def exists(self) -> bool:
        return bool(self._log_names())

    def _commits(self) -> list[Commit]:
        """All commits, newest first (metadata only; one small file each)."""
        return [self._load(n) for n in reversed(self._log_names())]

    def history(self) -> DataFrame:
        """Commit history as a DataFrame, newest first."""
        rows = [
            (c.version, c.data_version, c.operation, c.rows, dt.datetime.fromisoformat(c.written_at))
            for c in self._commits()
        ]
        return self.spark.createDataFrame(rows, LOG_SCHEMA)

    def current(self) -> Commit | None:
        names = self._log_names()
        return self._load(names[-1]) if names else None

    def commits_after(self, version: int | None) -> list[Commit]:
        """Commits newer than ``version``, oldest first; only their documents are read."""
        return [self._load(n) for n in self._log_names() if version is None or int(n.split(".")[0]) > version]

    def commit(self, version: int) -> Commit:
        name = f"{version:020d}.json"
        if name not in self._log_names():
            raise KeyError(f"{self.path}: no version {version}")
        return self._load(name)

    def _append_log(self, commit: Commit) -> Commit:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        d = asdict(commit)
        d["written_at"] = now
        write_text(self.spark, f"{self.log_path}/{commit.version:020d}.json", json.dumps(d))
        return Commit(**d)

    def version_as_of(self, ts) -> int:
        """The version readers saw at wall-clock time ``ts`` (UTC, naive)."""
        for c in self._commits():
            if dt.datetime.fromisoformat(c.written_at) <= ts:
                return c.version
        raise KeyError(f"{self.path}: no version at or before {ts}")

    def changed_buckets(self, from_version: int, to_version: int) -> list[int]:
        """Buckets whose data differs between two versions of a bucketed table
        (a bucket with the same data version in both manifests is identical)."""
        old, new = self.commit(from_version), self.commit(to_version)
        if old.layout != new.layout:
            raise ValueError(f"{self.path}: versions {from_version} and {to_version} are bucketed differently")
        a, b = old.manifest or {}, new.manifest or {}
        return sorted(int(k) for k in set(a) | set(b) if a.get(k, [None])[0] != b.get(k, [None])[0])

    # --- read ------------------------------------------------------------
    def read(self, version: int | None = None, buckets=None, as_of=None) -> DataFrame:
        """A version's rows (latest, by number, or as of a time); for bucketed
        tables optionally only some buckets."""
        if as_of is not None:
            version = self.version_as_of(as_of)
        c = self.current() if version is None else self.commit(version)
        if c is None:
            raise FileNotFoundError(f"{self.path}: no committed version")
        return self.read_commit(c, buckets)

    def read_commit(self, c: Commit, buckets=None) -> DataFrame:
        """The rows of a commit, published or not."""
        schema = T.StructType.fromJson(json.loads(c.schema)) if c.schema else None
        if c.manifest is None:
            # The commit records the schema: no footer-based schema inference.
            reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
            return reader.parquet(self.data_path(c.data_version, c.data_dir))
        wanted = c.manifest.keys() if buckets is None else [str(b) for b in buckets if str(b) in c.manifest]
        paths = [f"{self.path}/{self._entry_dir(c.manifest[b])}/{BUCKET}={b}" for b in sorted(wanted, key=int)]
        if not paths:
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --- write -----------------------------------------------------------
    def write(self, df: DataFrame, operation: str = "write", observe: list | None = None, replace_buckets=None):
        """Write ``df`` as a new version and publish it. Returns ``(Commit, metrics)``.

        The row count (and any extra ``observe`` aggregate columns) ride on the
        write through an ``Observation``. For a bucketed table, ``replace_buckets``
        names the buckets ``df`` replaces; every other bucket of the current
        version is carried forward unchanged (``None`` replaces all).
        """
        commit, metrics = self.stage_write(df, operation, observe, replace_buckets)
        return self.publish(commit), metrics

    def publish(self, commit: Commit) -> Commit:
        """Serve a staged commit."""
        return self._append_log(commit)

    def stage_write(
        self, df: DataFrame, operation: str = "write", observe: list | None = None, replace_buckets=None, finish=None, source_version: int | None = None, drop=()
    ):
        """Write the data of a new version without serving it. ``finish`` is
        applied to the frame after any repartitioning, in the stage that
        writes, so what it observes counts every row once even if earlier
        stages are run again; ``drop`` names columns it adds for ``observe``
        alone. For a bucketed table the frame then has ``BUCKET`` and ``SLOT``,
        and lies by ``SLOT``. Returns ``(Commit, metrics)``."""
        current = self.current()
        version = 0 if current is None else current.version + 1
        if replace_buckets is not None:
            self._require_layout(current)
        obs = Observation(f"snapshot_{version}_{uuid.uuid4().hex[:8]}")  # unique per write
        exprs = [F.count(F.lit(1)).alias("rows"), *(observe or [])]
        out, dir_name = self._fresh_data_path(version)
        if not self.bucketed:
            done = finish(df) if finish else df
            done = done.drop(*drop) if drop else done
            done.observe(obs, *exprs).write.mode("errorifexists").parquet(out)
            metrics = observed_values(obs, done, exprs)
            return Commit(
                version, version, operation, int(metrics["rows"]), schema=done.schema.json(), data_dir=dir_name, source_version=source_version, bytes=metrics.get("bytes")
            ), metrics

        # Rows of a bucket meet in one task, which keeps one file per bucket, whatever the input partitioning.
        # The task is named, not hashed: buckets share one only where there are fewer tasks than buckets.
        cap = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        n_out = cap if replace_buckets is None else max(1, min(cap, len(replace_buckets)))
        bucketed = df.withColumn(BUCKET, self.bucket_expr())
        slot = F.pmod(F.col(BUCKET), F.lit(n_out))
        if replace_buckets is not None and n_out == len(replace_buckets) <= LISTED_BUCKETS:
            listed = F.array(*[F.lit(int(b)).cast(bucketed.schema[BUCKET].dataType) for b in sorted(replace_buckets)])
            slot = F.greatest(F.array_position(listed, F.col(BUCKET)) - 1, F.lit(0))
        done = bucketed.withColumn(SLOT, slot.cast("int")).repartitionById(n_out, SLOT)
        done = finish(done) if finish else done
        kept = done.observe(obs, *exprs).drop(SLOT, *drop)
        writer = kept.write.mode("errorifexists").partitionBy(BUCKET)
        if self.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", int(self.max_records_per_file))
        writer.parquet(out)
        metrics = observed_values(obs, done, exprs)
        schema = T.StructType([f for f in kept.schema.fields if f.name != BUCKET])
        # Rows per written bucket, read back from storage (one row per bucket).
        written = {}
        if metrics["rows"]:
            counts = self.spark.read.option("basePath", out).parquet(out).groupBy(BUCKET).count().collect()
            written = {str(r[BUCKET]): [version, int(r["count"]), dir_name] for r in counts}
        base = {}
        if current is not None and current.manifest is not None and replace_buckets is not None:
            gone = {str(b) for b in replace_buckets}
            base = {b: v for b, v in current.manifest.items() if b not in gone}
        manifest = {**base, **written}
        rows = sum(v[1] for v in manifest.values())
        return Commit(
            version, version, operation, rows, schema=schema.json(), manifest=manifest, data_dir=dir_name, layout=self.layout, source_version=source_version
        ), metrics

    def create_empty(self, schema: T.StructType) -> Commit:
        """Create the table with no rows if it has no version yet (idempotent)."""
        current = self.current()
        if current is not None:
            return current
        commit, _ = self.write(empty_frame(self.spark, schema), operation="create")
        return commit

    def restore(self, version: int) -> Commit:
        """Serve an older version again, as a new commit (no data is copied)."""
        t = self.commit(version)
        current = self.current()
        commit = Commit(
            current.version + 1, t.data_version, f"restore {version}", t.rows, schema=t.schema, manifest=t.manifest, data_dir=t.data_dir,
            layout=t.layout, source_version=t.source_version, bytes=t.bytes,
        )
        return self._append_log(commit)

    def vacuum(self, keep_last: int = 10, dry_run: bool = False) -> list[str]:
        """Delete data no longer referenced by the newest ``keep_last`` commits.

        Unbucketed tables drop whole ``v=...`` directories; bucketed tables drop
        single bucket directories, since an old version's other buckets may still
        be carried forward. Commit documents are kept, so history stays readable;
        only reading a vacuumed version fails. Returns the removed paths.
        """
        if keep_last < 1:
            raise ValueError("keep_last must be at least 1")
        kept = [self._load(n) for n in reversed(self._log_names()[-keep_last:])]
        if not kept:
            return []
        used_dirs, used_buckets = set(), set()
        for c in kept:
            if c.manifest is None:
                used_dirs.add(c.data_dir or f"v={c.data_version}")
            else:
                for b, entry in c.manifest.items():
                    used_dirs.add(self._entry_dir(entry))
                    used_buckets.add((self._entry_dir(entry), f"{BUCKET}={b}"))
        removed = []
        for d in list_dirs(self.spark, self.path):
            if not d.startswith("v="):
                continue
            if d not in used_dirs:
                removed.append(f"{self.path}/{d}")
                continue
            if any(c.manifest is not None for c in kept):
                for sub in list_dirs(self.spark, f"{self.path}/{d}"):
                    if sub.startswith(f"{BUCKET}=") and (d, sub) not in used_buckets:
                        removed.append(f"{self.path}/{d}/{sub}")
        if not dry_run:
            for path in removed:
                delete_path(self.spark, path)
        return removed

    def stored_rows(self, version: int | None = None) -> int:
        """Row count of a version as stored. Unbucketed: read back (parquet
        footers). Bucketed: the manifest, whose per-bucket counts were read
        back from storage when each bucket was written."""
        return self.rows_of(self.current() if version is None else self.commit(version))

    def rows_of(self, c: Commit) -> int:
        if c.manifest is not None:
            return sum(v[1] for v in c.manifest.values())
        return self.read_commit(c).count()
