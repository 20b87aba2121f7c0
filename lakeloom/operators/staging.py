"""Staging assembly: live flag, tombstones, schema conformance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETE_FLAG = "is_deleted"
REJECT_COL = "_reject"


def flag_live(df: DataFrame, flag: str = DELETE_FLAG) -> DataFrame:
    """Extracted rows are live: ``is_deleted = false``."""
    return df.withColumn(flag, F.lit(False))


def tombstones(delete_keys: DataFrame, flag: str = DELETE_FLAG) -> DataFrame:
    """Delete keys as rows with ``is_deleted = true``; other columns come out NULL
    when unioned by name."""
    return delete_keys.withColumn(flag, F.lit(True))


def stage_batch(live: DataFrame, delete_keys: DataFrame | None = None, flag: str = DELETE_FLAG, keys=None) -> DataFrame:
    """Live rows plus tombstones, unioned by name (missing payload columns are NULL).

    With ``keys``, a live row whose key is also in the delete set is dropped:
    the change log's latest operation (a delete committed after the row was
    read) wins, and the batch keeps one row per key. A union with an empty
    delete set costs nothing, so no emptiness probe is run.
    """
    if delete_keys is not None and keys:
        live = live.join(delete_keys.select(*keys), list(keys), "left_anti")
    staged = flag_live(live, flag)
    if delete_keys is None:
        return staged
    return staged.unionByName(tombstones(delete_keys, flag), allowMissingColumns=True)


# Any string Spark can cast to an integral type has this shape (padding,
# optional sign, digits, optional fraction); it is a superset, so a value not
# matching it certainly fails and skips the costly failing-cast path, while a
# matching value is still decided by try_cast itself.
_PAD = r"[\p{javaWhitespace}\p{Cntrl}\x{80}-\x{9F}]*"
_INTEGRAL_SHAPE = rf"^{_PAD}[+-]?[0-9]*(\.[0-9]*)?{_PAD}$"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_type(target_type):
    return T._parse_datatype_string(target_type) if isinstance(target_type, str) else target_type


def safe_cast(col, source_type: T.DataType, target_type):
    """``try_cast`` with the integral shape shortcut: NULL when the cast fails."""
    target_type = _as_type(target_type)
    if isinstance(source_type, T.StringType) and isinstance(target_type, _INTEGRAL):
        return F.when(col.rlike(_INTEGRAL_SHAPE), col.try_cast(target_type))
    return col.try_cast(target_type)


def cast_fails(col, source_type: T.DataType, target_type):
    """True when a non-NULL value does not survive ``try_cast`` to ``target_type``."""
    return col.isNotNull() & safe_cast(col, source_type, target_type).isNull()


def _failed(name: str, source_type: T.DataType, target_type: T.DataType):
    if source_type == target_type:
        return None
    return cast_fails(F.col(name), source_type, target_type)


def conform(df: DataFrame, schema: T.StructType, rename: dict | None = None, keep=(DELETE_FLAG,)) -> DataFrame:
    """Select and cast to the declared schema, in schema order, and mark rejects.

    Casting uses ``try_cast``; a row with any value that fails its cast keeps
    NULL there and gets the failing column names in ``_reject`` (NULL when the
    row is clean). Declared-NOT-NULL columns holding NULL are rejects too,
    except on tombstones, whose payload is NULL by construction. Extra columns
    listed in ``keep`` (present in ``df``) are carried through after the schema.
    """
    rename = rename or {}
    src = {f.name: f.dataType for f in df.schema.fields}
    outs, checks = [], []
    is_tomb = F.coalesce(F.col(DELETE_FLAG), F.lit(False)) if DELETE_FLAG in src else F.lit(False)
    for f in schema.fields:
        name = rename.get(f.name, f.name)
        if name not in src:
            outs.append(F.lit(None).cast(f.dataType).alias(f.name))
            if not f.nullable:
                checks.append(F.when(~is_tomb, F.lit(f.name)))
            continue
        outs.append(safe_cast(F.col(name), src[name], f.dataType).alias(f.name))
        bad = _failed(name, src[name], f.dataType)
        if bad is not None:
            checks.append(F.when(bad, F.lit(f.name)))
        if not f.nullable:
            checks.append(F.when(F.col(name).isNull() & ~is_tomb, F.lit(f.name)))
    extra = [F.col(c) for c in keep if c in src and c not in schema.fieldNames()]
    reason = F.nullif(F.concat_ws(",", *checks), F.lit("")) if checks else F.lit(None).cast("string")
    return df.select(*outs, *extra, reason.alias(REJECT_COL))


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col(REJECT_COL).isNull()).drop(REJECT_COL)


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col(REJECT_COL).isNotNull())


def conform_schema(df: DataFrame, schema: T.StructType, rename: dict | None = None) -> DataFrame:
    """Accepted rows only, with exactly the declared columns."""
    return accepted(conform(df, schema, rename, keep=()))


def cast_rejects(df: DataFrame, columns: dict) -> DataFrame:
    """Rows where some listed column fails its cast: ``{column: target_type}``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    conds = [cast_fails(F.col(c), types[c], t) for c, t in columns.items()]
    return df.where(reduce(lambda a, b: a | b, conds))
