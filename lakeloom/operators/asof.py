"""As-of join: each fact with the version of its key that was valid at its time.

No range join and no whole key in one task. Facts and versions are merged into
one stream per (key, order bucket); inside a bucket the last version seen is
carried on by a window. What a bucket inherits from earlier ones is one row
per (key, bucket): the last version of the nearest earlier bucket that has
one. A bucket in which a key has very many facts is split: its facts are dealt
over several groups by a hash of the whole row, so that a task that runs again
deals them alike, and its versions, as many times, are copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Facts of a (key, bucket) in one group, about.
GROUP_ROWS = 200_000
_B, _SPLIT, _SIDE, _VER, _FACT, _IN = "_a_bkt", "_a_split", "_a_side", "_a_version", "_a_fact", "_a_inherited"


def order_bucket(col: str, dtype: T.DataType, width: int) -> Column:
    """``width`` days of a date or time, or ``width`` steps of an integral order column, to a bucket."""
    whole = f"CAST(`{col}` AS BIGINT)"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        whole = f"CAST(unix_date(CAST(`{col}` AS DATE)) AS BIGINT)"
    elif not isinstance(dtype, T.IntegralType):
        raise ValueError(f"{col}: buckets need an integral, date or time column, not {dtype.simpleString()}")
    return F.expr(f"({whole} - pmod({whole}, {int(width)}L)) div {int(width)}L")


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys,
    fact_time: str,
    version_time: str,
    version_cols=None,
    version_seq: str | None = None,
    valid_to: str | None = None,
    how: str = "left",
    bucket_width: int | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Every fact with the columns ``version_cols`` of the latest version of its
    key at or before ``fact_time`` (``keys`` may be empty: one stream for all).

    Of versions with equal time the one with the highest ``version_seq`` holds.
    With ``valid_to``, a version that ended at or before the fact's time is
    none. ``how="left"`` keeps facts without version (NULLs), ``"inner"`` drops
    them. NULL keys match NULL keys; a NULL time on either side matches nothing.
    ``bucket_width`` is in days for times (default 1), else in steps (default 2**20).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join {how!r}")
    keys = list(keys)
    dtype = facts.schema[fact_time].dataType
    if dtype != versions.schema[version_time].dataType:
        raise ValueError(f"{fact_time} and {version_time} differ in type")
    taken = [c for c in (version_cols if version_cols is not None else versions.columns) if c not in keys]
    clash = [c for c in taken if c in facts.columns]
    if clash:
        raise ValueError(f"facts have columns {clash} too: name the version columns to take")
    width = bucket_width or (1 << 20 if isinstance(dtype, T.IntegralType) else 1)

    # Order within a stream: time, versions before facts of the same time, then the sequence.
    seq = F.col(version_seq) if version_seq else F.lit(0)
    held = [*taken, *([valid_to] if valid_to and valid_to not in taken else [])]
    v = versions.where(F.col(version_time).isNotNull()).select(
        *keys, F.col(version_time).alias("_a_time"), seq.cast("long").alias("_a_seq"), F.struct(F.lit(True).alias("_a_is"), *held).alias(_VER),
        order_bucket(version_time, dtype, width).alias(_B),
    )
    f = facts.select(*keys, F.col(fact_time).alias("_a_time"), F.struct(*facts.columns).alias(_FACT), order_bucket(fact_time, dtype, width).alias(_B))

    # How many groups a (key, bucket) needs: counts, combined map-side.
    crowded = f.groupBy(*keys, _B).agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("int").alias("_a_groups")).where(F.col("_a_groups") > 1)
    f = _with(f, crowded, keys, "_a_groups").withColumn(_SPLIT, F.pmod(F.xxhash64(_FACT), F.coalesce("_a_groups", F.lit(1))).cast("int"))
    copies = _with(v, crowded, keys, "_a_groups").withColumn(_SPLIT, F.explode(F.sequence(F.lit(0), F.coalesce("_a_groups", F.lit(1)) - 1)))

    # What each (key, bucket) with facts inherits: one row per (key, bucket) of either side.
    ends = v.groupBy(*keys, _B).agg(F.max_by(_VER, F.struct("_a_time", "_a_seq")).alias(_IN))
    marks = ends.unionByName(f.select(*keys, _B).distinct(), allowMissingColumns=True)
    marks = marks.groupBy(*keys, _B).agg(F.first(_IN, ignorenulls=True).alias(_IN))
    earlier = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    inherited = marks.select(*keys, _B, F.last(_IN, ignorenulls=True).over(earlier).alias(_IN)).where(F.col(_IN).isNotNull())

    stream = f.select(*keys, _B, _SPLIT, "_a_time", F.lit(1).alias(_SIDE), F.lit(0).cast("long").alias("_a_seq"), F.lit(None).cast(v.schema[_VER].dataType).alias(_VER), _FACT)
    stream = stream.unionByName(copies.select(*keys, _B, _SPLIT, "_a_time", F.lit(0).alias(_SIDE), "_a_seq", _VER), allowMissingColumns=True)
    upto = Window.partitionBy(*keys, _B, _SPLIT).orderBy("_a_time", _SIDE, "_a_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = stream.withColumn(_VER, F.last(_VER, ignorenulls=True).over(upto)).where(F.col(_SIDE) == 1)
    found = _with(merged, inherited, keys, _IN).withColumn(_VER, F.when(F.col("_a_time").isNotNull(), F.coalesce(_VER, _IN)))
    if valid_to:
        ended = F.coalesce(F.col(f"{_VER}.{valid_to}") <= F.col("_a_time"), F.lit(False))
        found = found.withColumn(_VER, F.when(~ended, F.col(_VER)))
    if how == "inner":
        found = found.where(F.col(_VER).isNotNull())
    return found.select(f"{_FACT}.*", *[F.col(f"{_VER}.`{c}`").alias(c) for c in taken])


def _with(df: DataFrame, per_bucket: DataFrame, keys, col: str) -> DataFrame:
    """``df`` with ``col`` of its (key, bucket), NULL where there is none. NULL keys are keys like any other."""
    other = per_bucket.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col(_B).alias("_o_bkt"), col)
    same = F.col(_B).eqNullSafe(F.col("_o_bkt"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return df.join(other, same, "left").drop("_o_bkt", *[f"_o_{k}" for k in keys])
