"""Where jobs write intermediate tables.

On a cluster the shared folder named by ``spark.checkpoint.dir`` is used;
nothing is written to a machine-local temporary folder there. Only a session
with a local master and no checkpoint directory (tests) gets one under the
system temp folder; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-ckpt-"))
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory URI under the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small metadata file whole or not at all: it is written under a
    temporary name and renamed. Fails if it already exists (so two writers
    cannot both claim the same commit name)."""
    jvm = spark._jvm
    fs, p = _fs(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex[:8]}")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(p), options)  # no overwrite
    except Exception:
        fs.delete(temporary, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isFile())
    return sorted(n for n in names if not n.startswith("."))  # not yet renamed


def empty_frame(spark: SparkSession, schema):
    """An empty DataFrame of ``schema``. Built on an empty RDD: writing an empty
    local relation takes a much slower path in Spark."""
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (used only for unreferenced snapshot data)."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
