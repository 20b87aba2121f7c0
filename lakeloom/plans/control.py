"""Control table: per loaded table, the last version consumed, versions to
skip (rolled back), the last run time and the high-water mark.

It is metadata, kept as small JSON documents next to the tables
(``<path>/<table>/<seq>.json``, newest wins, never overwritten), so updating
it costs a file write rather than a Spark job. ``frame()`` exposes the
current rows as a DataFrame.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.plans.workspace import delete_path, list_dirs, list_files, read_text, write_text
from lakeloom.spec import check_identifier

#: Control rows of a table that are kept, the current one included.
KEPT_ROWS = 50

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("delta_table_name", T.StringType(), False),
        T.StructField("last_version_run", T.LongType(), True),
        T.StructField("skip_versions", T.StringType(), True),
        T.StructField("last_run_timestamp", T.TimestampNTZType(), True),
        T.StructField("high_water_mark", T.StringType(), True),
    ]
)


def _encode_mark(value) -> str | None:
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def _decode_mark(text: str | None, like):
    if text is None:
        return None
    if isinstance(like, dt.datetime):
        return dt.datetime.fromisoformat(text)
    return type(like)(text)


class ControlTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _docs(self, name: str) -> list[str]:
        return [n for n in list_files(self.spark, f"{self.path}/{check_identifier(name)}") if n.endswith(".json")]

    def row(self, name: str) -> Row | None:
        docs = self._docs(name)
        if not docs:
            return None
        d = json.loads(read_text(self.spark, f"{self.path}/{name}/{docs[-1]}"))
        ts = d.get("last_run_timestamp")
        d["last_run_timestamp"] = dt.datetime.fromisoformat(ts) if ts else None
        return Row(**{f.name: d.get(f.name) for f in CONTROL_SCHEMA.fields})

    def frame(self) -> DataFrame:
        rows = [self.row(n) for n in list_dirs(self.spark, self.path)]
        return self.spark.createDataFrame([tuple(r) for r in rows if r is not None], CONTROL_SCHEMA)

    def _put(self, name, last_version=None, skip=None, run_ts=None, mark=None) -> None:
        if run_ts is not None and not isinstance(run_ts, dt.datetime):
            # a sequence-bounded run: record when it happened
            run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        old = self.row(name)
        doc = {
            "delta_table_name": name,
            "last_version_run": last_version if last_version is not None else (old.last_version_run if old else None),
            "skip_versions": skip if skip is not None else (old.skip_versions if old else None),
            "last_run_timestamp": run_ts if run_ts is not None else (old.last_run_timestamp if old else None),
            "high_water_mark": mark if mark is not None else (old.high_water_mark if old else None),
        }
        if isinstance(doc["last_run_timestamp"], dt.datetime):
            doc["last_run_timestamp"] = doc["last_run_timestamp"].isoformat(sep=" ")
        docs = self._docs(name)
        seq = int(docs[-1].split(".")[0]) + 1 if docs else 0
        write_text(self.spark, f"{self.path}/{name}/{seq:020d}.json", json.dumps(doc))
        # Older rows are kept for inspection, the newest of them only.
        for old_doc in docs[: -KEPT_ROWS + 1]:
            delete_path(self.spark, f"{self.path}/{name}/{old_doc}")

    # --- high-water mark (kept here so an empty batch cannot reset it) -----
    def high_water_mark(self, name: str, floor):
        old = self.row(name)
        mark = _decode_mark(old.high_water_mark, floor) if old is not None else None
        return floor if mark is None else mark

    def advance_mark(self, name: str, observed, floor, run_ts=None) -> object:
        """Store ``max(old mark, observed)``; the mark never moves back."""
        old = self.high_water_mark(name, floor)
        new = old if observed is None else max(old, observed)
        self._put(name, run_ts=run_ts, mark=_encode_mark(new))
        return new

    # --- versions -------------------------------------------------------
    def mark_consumed(self, name: str, version: int, run_ts) -> None:
        self._put(name, last_version=version, run_ts=run_ts)

    def record_skip(self, name: str, version: int, run_ts=None) -> None:
        old = self.row(name)
        current = [v for v in ((old.skip_versions or "") if old else "").split(",") if v.strip()]
        if str(version) not in current:
            current.append(str(version))
        self._put(name, skip=",".join(current), run_ts=run_ts)


def pending_versions(history: DataFrame, control, name: str) -> DataFrame:
    """Versions a downstream reader still has to consume: newer than the last
    consumed one and not in the skip list.

    ``control`` is a ``ControlTable`` or its ``frame()``. The table's control
    row is one metadata row (the table is keyed by name), so it is read once
    and applied as a literal filter on the history: no join.
    """
    if isinstance(control, ControlTable):
        row = control.row(name)
    else:
        rows = control.where(F.col("delta_table_name") == F.lit(name)).limit(2).collect()
        if len(rows) > 1:
            raise ValueError(f"control table has several rows for {name!r}")
        row = rows[0] if rows else None
    last = row.last_version_run if row is not None and row.last_version_run is not None else -1
    skip = [int(v) for v in ((row.skip_versions or "") if row is not None else "").split(",") if v.strip()]
    keep = F.col("version") > F.lit(last)
    if skip:
        keep = keep & ~F.col("version").isin(skip)
    return history.where(keep).select("version")
