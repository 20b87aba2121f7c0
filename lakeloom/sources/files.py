"""File sources: CSV ingest with a declared schema, parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, keep_corrupt: bool = False, **options) -> DataFrame:
    """Read CSV with an explicit schema (no inference pass over the data).

    With ``keep_corrupt`` the malformed lines land in ``_corrupt_record``
    instead of failing the job, so they can be split into a reject frame.
    """
    reader = spark.read.option("header", str(header).lower()).options(**options)
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("errorifexists").option("header", str(header).lower()).csv(path)


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType, table, header: bool = False):
    """CSV → new snapshot version of ``table`` (a ``SnapshotTable``)."""
    return table.write(read_csv(spark, path, schema, header=header), operation="csv ingest")
