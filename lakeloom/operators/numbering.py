"""Global row numbering without funnelling the table through one task.

``row_number() OVER (ORDER BY k)`` with no partition clause makes Spark move
every row into a single partition. Here the table is range-partitioned on
the order columns, sorted inside each partition and written once, one file a
partition, under the session's checkpoint directory. From then on a row's
place is fixed: its file and its position there (``_metadata.row_index``),
whatever is read or recomputed later. Then:

1. one row per file: its row count (from the footers; no column is read);
2. a running sum over those few rows, in file order, gives each file's offset;
3. each row's number = offset of its file + its position + 1.

The offsets frame has one row per file, so broadcasting it is bounded by the
partition count, not by the data. The files are the caller's to delete once
the numbered rows have been written (``folders``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.plans.workspace import empty_frame, work_dir

_FILE, _OFF, _TIE = "_rn_file", "_rn_off", "_rn_tie"


def number_rows(df: DataFrame, order_cols, name: str = "row_number", num_partitions: int | None = None, folders: list[str] | None = None) -> DataFrame:
    """All columns of ``df`` plus ``name`` = 1..N in ``order_cols`` order.
    The folder that the result is read from is added to ``folders``."""
    spark = df.sparkSession
    order_cols = list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A scan-position tiebreaker spreads rows with equal order values over
    # partitions (ties may take any order, as in SQL); it is dropped after.
    tie = F.monotonically_increasing_id().alias(_TIE)
    ranged = df.select("*", tie).repartitionByRange(n, *order_cols, _TIE).sortWithinPartitions(*order_cols, _TIE).drop(_TIE)
    path = work_dir(spark, "numbered")
    if folders is not None:
        folders.append(path)
    # One file a partition, in the order of the partitions' numbers.
    ranged.write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    if not stored.inputFiles():
        return empty_frame(spark, df.schema).select("*", F.lit(0).cast("long").alias(name))
    place = stored.metadataColumn("_metadata")
    counts = stored.select(place["file_name"].alias(_FILE)).groupBy(_FILE).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_FILE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFF))
    located = stored.select(*[F.col(f"`{c}`") for c in df.columns], place["file_name"].alias(_FILE), place["row_index"].alias("_rn_pos"))
    numbered = located.join(F.broadcast(offsets), _FILE, "inner")
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(_OFF) + F.col("_rn_pos") + F.lit(1)).cast("long").alias(name))
