"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.plans.workspace import delete_path, work_dir

#: Single white-space characters that separate words (fixed by the contracts).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lists of the folders made in each open scope, innermost last. Every thread has its own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def collecting(paths: list[str]):
    """Folders made inside are added to ``paths``, whose owner deletes them."""
    before = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(before)


@contextmanager
def scratch(spark: SparkSession):
    """Folders made inside are deleted at the end, but for those of :func:`kept`."""
    paths: list[str] = []
    try:
        with collecting(paths):
            yield
    finally:
        for p in paths:
            delete_path(spark, p)


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = work_dir(spark, name)
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored so that it outlives the innermost :func:`scratch`."""
    before = _SCOPES.set(_SCOPES.get()[:-1])
    try:
        return stored(df, name)
    finally:
        _SCOPES.reset(before)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, computes once.
    Also returns the folder."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def fresh_name(taken, name: str) -> str:
    """``name``, lengthened until no column of ``taken`` has it."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name


def _reads_files(df: DataFrame) -> bool:
    """Whether the rows are those of files: a scan, perhaps filtered or projected."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def folder_of(df: DataFrame) -> str | None:
    """The folder of Parquet files that ``df`` is all of, read as it is; None for anything else."""
    plan = df._jdf.queryExecution().analyzed()
    if plan.nodeName() != "LogicalRelation":
        return None
    location = plan.relation().location()
    roots = location.rootPaths()
    if roots.size() != 1 or location.partitionSchema().size():
        return None
    if "parquet" not in plan.relation().fileFormat().toString().lower():
        return None
    return roots.head().toString()


def located(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` with a column, whose name is returned, that tells its rows apart
    and is the same in every reading: a hash of the row's file and its place
    there. Rows that do not come from files are stored first."""
    if not _reads_files(df):
        df = stored(df, name)
    column, file = fresh_name(df.columns, "row_place"), df.metadataColumn("_metadata")["file_path"]
    clash = df.select(file.alias("f")).groupBy(F.xxhash64("f")).agg(F.min("f").alias("a"), F.max("f").alias("b")).where("a <> b")
    if clash.head(1):  # no value of the table is read for this
        df = stored(df, name)
        return located(df, name)
    place = F.struct(F.xxhash64(file).alias("file"), df.metadataColumn("_metadata")["row_index"].alias("index"))
    return df.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(column)), column


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
