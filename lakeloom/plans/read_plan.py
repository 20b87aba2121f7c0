"""Read planning: bounds for a partitioned source scan."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.literals import typed_lit


@dataclass(frozen=True)
class ReadPlan:
    """Partitioning of a source scan on a real (integer or date) key column.

    Bounds only set the stride of the per-partition ranges; rows outside them
    still land in the first or last partition.
    """

    column: str | None
    lower: object
    upper: object
    num_partitions: int
    row_count: int

    @property
    def partitioned(self) -> bool:
        return bool(self.column) and self.num_partitions > 1 and self.lower is not None and self.upper is not None


def partition_bounds(df: DataFrame, column: str) -> DataFrame:
    """``min``, ``max`` and ``count`` in one pass (pushed to the database on JDBC)."""
    return df.agg(
        F.min(column).alias("lower_bound"),
        F.max(column).alias("upper_bound"),
        F.count(F.lit(1)).alias("row_count"),
    )


def plan_read(df: DataFrame, column: str | None, num_partitions: int = 1, rows_per_partition: int | None = None) -> ReadPlan:
    """Build a ``ReadPlan`` from one bounds query. With ``rows_per_partition``
    the partition count follows the population size instead of a fixed number."""
    if not column:
        n = df.count()
        return ReadPlan(None, None, None, 1, n)
    row = partition_bounds(df, column).first()
    n = row["row_count"]
    parts = num_partitions
    if rows_per_partition:
        parts = max(1, -(-n // rows_per_partition))
    if row["lower_bound"] is None or row["lower_bound"] == row["upper_bound"]:
        parts = 1
    return ReadPlan(column, row["lower_bound"], row["upper_bound"], parts, n)


#: Candidate cells for each range that is asked for: a range is within about this share of the mean.
CELLS = 16


@dataclass(frozen=True)
class KeyRange:
    """Rows with ``lower <= key < upper`` (None: unbounded) and their exact number.
    ``with_nulls``: rows without key as well; ``only_nulls``: these alone."""

    lower: object
    upper: object
    rows: int
    with_nulls: bool = False
    only_nulls: bool = False

    def predicate(self, column: str) -> str:
        """As SQL, for one partition of a JDBC read."""
        if self.only_nulls:
            return f"{column} IS NULL"
        parts = [f"{column} >= {_sql(self.lower)}"] if self.lower is not None else []
        parts += [f"{column} < {_sql(self.upper)}"] if self.upper is not None else []
        both = " AND ".join(parts) or ("1 = 1" if self.with_nulls else f"{column} IS NOT NULL")
        return f"({both} OR {column} IS NULL)" if self.with_nulls and parts else both


def _sql(value) -> str:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else str(value)
    return "'" + text.replace("'", "''") + "'"


def _cell(column: str, cuts: list, data_type) -> Column:
    """How many of the sorted ``cuts`` are at or below the key, by halving steps."""
    size = 1 << len(cuts).bit_length()
    array = F.array(*[typed_lit(c, data_type) for c in cuts])
    steps = F.array(*[F.lit(size >> k) for k in range(1, size.bit_length())])
    reached = lambda at, step: (at + step <= len(cuts)) & (F.get(array, F.least(at + step, F.lit(len(cuts))) - 1) <= F.col(column))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at))


def _counted(df: DataFrame, column: str, cuts: list) -> dict[int, int]:
    cell = _cell(column, cuts, df.schema[column].dataType) if cuts else F.lit(0)
    return {r["cell"]: r["n"] for r in df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}


def balanced_ranges(df: DataFrame, column: str, num_ranges: int, tolerance: float = 1.2, max_refinements: int = 3) -> list[KeyRange]:
    """Ranges of ``column`` with about equal numbers of rows, however skewed the key.

    A quantile sketch proposes ``CELLS`` cuts per range; the rows of every cell
    are then counted exactly (one aggregation, combined map-side). A cell with
    more than an eighth of a range is sketched and counted again on its own
    rows, up to ``max_refinements`` times. Neighbouring cells are joined to
    ranges of at most ``tolerance`` times the mean. Only a single key value
    that has more rows than that makes a larger range, alone. Rows without key
    go with the first range if they fit, else alone. At most
    ``CELLS * num_ranges`` cuts and counts reach the driver a round.
    """
    if num_ranges < 1:
        raise ValueError("at least one range")
    keyed = df.where(F.col(column).isNotNull())
    total, nulls, least = df.agg(F.count(F.lit(1)), F.count_if(F.col(column).isNull()), F.min(column)).first()
    if least is None:
        return [KeyRange(None, None, total, True)]
    mean = (total - nulls) / num_ranges

    def sketch(frame: DataFrame, cells: int) -> list:
        found = frame.agg(F.percentile_approx(column, [i / cells for i in range(1, cells)], 20 * cells)).first()[0] if cells > 1 else []
        return sorted({v for v in found if v > least})

    cuts = sketch(keyed, CELLS * num_ranges)
    for _ in range(max_refinements):
        counts = _counted(keyed, column, cuts)
        edges = [None, *cuts, None]
        large = [i for i in range(len(edges) - 1) if counts.get(i, 0) > mean / 8]
        more: set = set()
        for i in large[: CELLS * num_ranges]:
            inside = keyed
            if edges[i] is not None:
                inside = inside.where(F.col(column) >= typed_lit(edges[i], df.schema[column].dataType))
            if edges[i + 1] is not None:
                inside = inside.where(F.col(column) < typed_lit(edges[i + 1], df.schema[column].dataType))
            lo, hi = inside.agg(F.min(column), F.max(column)).first()
            if lo == hi:
                continue  # one value
            # The value most of the cell may have gets a cell of its own.
            after = inside.where(F.col(column) > typed_lit(lo, df.schema[column].dataType)).agg(F.min(column)).first()[0]
            more |= {lo, after, *sketch(inside, max(2, min(64, math.ceil(16 * counts[i] / max(mean, 1)))))}
        more = {v for v in more if v is not None and v > least} - set(cuts)
        if not more:
            break
        cuts = sorted({*cuts, *more})
    counts = _counted(keyed, column, cuts)
    ranges: list[KeyRange] = []
    lower, held = None, 0
    for i, upper in enumerate([*cuts, None]):
        n = counts.get(i, 0)
        # Closed where the next cell would go beyond the mean by more than it lacks now, or beyond the tolerance.
        if held and n and (held + n > tolerance * mean or held + n - mean > mean - held):
            ranges.append(KeyRange(lower, edge, held))
            lower, held = edge, 0
        held, edge = held + n, upper
    ranges.append(KeyRange(lower, None, held))
    first = ranges[0]
    if first.rows + nulls > tolerance * mean:
        return [*([KeyRange(None, None, nulls, only_nulls=True)] if nulls else []), *ranges]
    return [KeyRange(first.lower, first.upper, first.rows + nulls, True), *ranges[1:]]
