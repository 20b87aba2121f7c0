r"""Exact deduplication as a stateful stream.

Texts are equal when they are identical after every run of white space
(``[\x20\x09-\x0D]+``) is replaced by one space. A structured stream over the
table's files keeps one state row per digest: the digest of the normalised
text, the stable identifier of the row that stays (the smallest id), a locator
of its content (file and row) and the number of rows seen. The state lives in
RocksDB on the executors' disks, is checkpointed to the shared folder and
never expires, so a run over further files under the same ``state_dir``, in the
same folder or another, goes on where the last one stopped, and a lost
executor costs one replay of the open micro-batch. Then a row's text is
compared with that of a row read earlier, where its file still lies; if it is
gone, the first row at hand stays. Files are known by name: rows of a file that
was written anew under its old name have no state, which is an error.

A digest seen more than once is a hit, not yet a duplicate: the bytes of every
hit are compared with those at the locator in its state row. Rows whose bytes
differ although their digests agree are grouped by their bytes instead.

Everything runs on DataFrame functions. The state is pre-aggregated before the
shuffle (a digest with a third of all rows reaches it as one row per task),
and both joins on the digest are plain shuffle joins whose hot partitions
Spark splits.

Nulls: a null text counts as empty; a null id never stays if the group has
another. Repeated rows are duplicates of each other; of rows with equal id the
one with the smallest locator stays. An empty table gives an empty result.
Very long texts are digested whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE_CLASS, folder, folder_of, fresh_name, kept, scratch, stored
from lakeloom.plans.workspace import path_exists

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All state partitions of an executor share one bounded block cache and write buffer.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # No log space set aside in advance: there are many state partitions, most of them small.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


#: Files are read however much older they are than the newest one seen.
MAX_FILE_AGE = "36500d"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = normalised(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ).withColumn("digest", digest(F.col("text")))


def _exactly(path: str) -> str:
    """A pattern that matches ``path`` alone: a stream's plain path must be a folder, a pattern may match one file."""
    return f"{path[:-1]}[{path[-1]}]"


def update_state(
    spark: SparkSession,
    path: str,
    state_dir: str,
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int = 1000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Stream the files that ``state_dir`` has not seen into its state and
    return the state: ``digest, keep (no_id, doc_id, file, row), n``."""
    path = path.rstrip("/")
    source = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).option("maxFileAge", MAX_FILE_AGE).parquet(_exactly(path))
    keyed = _keyed(source, id_col, text_col, digest)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    state = keyed.groupBy("digest").agg(F.min(order).alias("keep"), F.count("*").alias("n"))
    with _settings(spark, ROCKSDB):
        query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", state_dir).trigger(availableNow=True).start()
        query.awaitTermination()
        return read_state(spark, state_dir)


def read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    found = spark.read.format("statestore").load(state_dir)
    keep, n = (f.name for f in found.schema["value"].dataType.fields)
    return found.select("key.digest", F.col(f"value.`{keep}`").alias("keep"), F.col(f"value.`{n}`").alias("n"))


def deduplicate(
    spark: SparkSession,
    path: str,
    state_dir: str | None = None,
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int = 1000,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_locator: bool = False,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` (and ``file, row``) of every row of the Parquet table at ``path``."""
    with scratch(spark):
        found = _deduplicated(spark, path, state_dir or folder(spark, "dedup-state"), digest, files_per_trigger, id_col, text_col, with_locator)
        return kept(found, "dedup-result")


def _deduplicated(spark, path, state_dir, digest, files_per_trigger, id_col, text_col, with_locator) -> DataFrame:
    docs = spark.read.parquet(path)
    state = update_state(spark, path, state_dir, digest, files_per_trigger, id_col, text_col)
    state = stored(state, "dedup-seen")

    hit = F.col("n") > 1
    seen = _keyed(docs, id_col, text_col, digest).withColumn("sha", F.sha2("text", 256)).join(state, "digest", "left")
    is_keep = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    seen = stored(seen.select("doc_id", "digest", "sha", F.col("keep.doc_id").alias("keep_id"), "keep", "n", is_keep.alias("is_keep"), "file", "row", F.when(hit, F.col("text")).alias("text")), "dedup-hits")
    if seen.where("n IS NULL").head(1):
        raise RuntimeError(f"{path} has rows that the state in {state_dir} has not: files read before were written anew under their old names")

    # The full bytes of every hit against those of the row that stays.
    hits = seen.where(hit)
    here = hits.where("is_keep").select("digest", F.col("text").alias("keep_text"))
    hits, at_locator = _keepers(spark, docs, hits, here, digest, id_col, text_col)
    checked = hits.join(at_locator, "digest").withColumn("same", F.col("text") == F.col("keep_text"))
    strangers = checked.where(~F.col("same")).select("doc_id", "digest", "sha", "text", "file", "row")
    n_strangers = strangers.groupBy("digest").agg(F.count("*").alias("strangers"))
    same = checked.where("same").join(n_strangers, "digest", "left").withColumn("n", F.col("n") - F.coalesce("strangers", F.lit(0)))

    # Equal digests, different bytes: grouped by the bytes.
    by_bytes = strangers.groupBy("digest", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    apart = strangers.join(by_bytes, ["digest", "text"])
    order = F.col("doc_id").asc_nulls_last(), "file", "row"
    apart = apart.withColumn("is_keep", F.row_number().over(Window.partitionBy("digest", "text").orderBy(*order)) == 1)

    columns = ["doc_id", "keep_id", F.col("n").alias("group_size"), F.col("is_keep").alias("kept"), F.col("sha").alias("text_sha256"), *(["file", "row"] if with_locator else [])]
    return seen.where(~hit).select(*columns).unionByName(same.select(*columns)).unionByName(apart.select(*columns))


def _keepers(spark, docs: DataFrame, hits: DataFrame, here: DataFrame, digest, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``hits``, and the text that stays of every digest of theirs. A state that is gone on with may name rows of
    tables read before: their texts are read at their locators. Where that file is gone, or holds something else
    there, the first of the rows at hand stays instead."""
    lacking = hits.select("digest", "keep").distinct().join(here, "digest", "left_anti")
    # Names of files read before, not rows.
    files = [r["file"] for r in lacking.select("keep.file").distinct().collect()]
    if not files:
        return hits, here
    left = [f for f in (f if path_exists(spark, f) else unquote(f) for f in files) if path_exists(spark, f)]
    there = lacking.where("false").select("digest", F.lit("").alias("keep_text"))
    if left:
        before = _keyed(spark.read.schema(docs.schema).parquet(*left), id_col, text_col, digest).withColumnRenamed("digest", "found")
        at = lacking.select("digest", F.col("keep.file").alias("file"), F.col("keep.row").alias("row"))
        there = before.join(at, ["file", "row"]).where("found = digest").select("digest", F.col("text").alias("keep_text"))
    there = stored(there, "dedup-earlier")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    gone = lacking.select("digest").join(there, "digest", "left_anti")
    elected = stored(hits.join(gone, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct(order.alias("at"), "text")).alias("first")), "dedup-elected")
    new = elected.select("digest", F.col("first.at").alias("at"))
    hits = hits.join(new, "digest", "left")
    is_first = (F.col("file") == F.col("at.file")) & (F.col("row") == F.col("at.row"))
    hits = hits.withColumn("is_keep", F.when(F.col("at").isNull(), F.col("is_keep")).otherwise(is_first))
    hits = hits.withColumn("keep_id", F.when(F.col("at").isNull(), F.col("keep_id")).otherwise(F.col("at.doc_id"))).drop("at")
    return hits, here.unionByName(there).unionByName(elected.select("digest", F.col("first.text").alias("keep_text")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that stay: of equal texts the row with the smallest id (of rows with equal id, one)."""
    spark = docs.sparkSession
    files = folder_of(docs)
    if files is None:
        files = folder(spark, "dedup-landing")
        docs.write.parquet(files)
        docs = spark.read.schema(docs.schema).parquet(files)
    gone = deduplicate(spark, files, id_col=id_col, text_col=text_col, with_locator=True).where("NOT kept").select("file", "row")
    place = docs.metadataColumn("_metadata")
    file, row = (fresh_name(docs.columns, f"dedup_{n}") for n in ("file", "row"))
    here = docs.select(*[F.col(f"`{c}`") for c in docs.columns], place["file_path"].alias(file), place["row_index"].alias(row))
    return here.join(gone.toDF(file, row), [file, row], "left_anti").select(*docs.columns)
