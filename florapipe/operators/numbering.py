"""Global positions and running sums without a one-task window.

Rows are range-partitioned and sorted, then written with Spark's own row id,
whose high bits are the partition and whose low bits the place in it.  What
is summed up in one place is one row per partition of that sort -- the
session's number of shuffle partitions, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florapipe.session import materialize

_MID, _PART = "__mid", "__part"


def _placed(df: DataFrame, order: Sequence[Column | str] | None, name: str) -> DataFrame:
    if order:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = materialize(df.withColumn(_MID, F.monotonically_increasing_id()), name)
    return placed.withColumn(_PART, F.shiftrightunsigned(_MID, 33))


def number_rows(df: DataFrame, order: Sequence[Column | str] | None, number: str, name: str = "numbered") -> DataFrame:
    """``df`` with its global 0-based position in ``order`` (None: in any order)."""
    placed = _placed(df, order, name)
    counts = placed.groupBy(_PART).agg(F.count("*").alias("__n"))
    starts = counts.select(_PART, (F.sum("__n").over(Window.orderBy(_PART)) - F.col("__n")).alias("__start"))
    # one row per task of the write above, a few bytes each
    return (placed.join(F.broadcast(starts), _PART)
            .withColumn(number, F.col("__start") + F.col(_MID).bitwiseAND(F.lit((1 << 33) - 1)))
            .drop(_PART, "__start", _MID))


def number_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], number: str) -> DataFrame:
    """The 0-based position of each row within its group: its global position
    in (group, order) less that of the group's first row.  A group of any size
    is spread over as many tasks as its rows fill."""
    at = materialize(number_rows(df, [*group, *order], "__at"), "numbered_rows")
    first = at.groupBy(*group).agg(F.min("__at").alias("__first"))
    # a written table, so that both sides of the join are dealt out anew and a hot group can be split
    first = materialize(first, "first_in_group").select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__first")
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return at.join(first, same).select(*df.columns, (F.col("__at") - F.col("__first")).alias(number))


def running_sums(df: DataFrame, order: Sequence[Column | str], value_cols: Sequence[str],
                 prefix: str = "cum_") -> DataFrame:
    """``df`` with the inclusive running sum of each of ``value_cols`` along
    ``order``: a running sum within each partition of the sort, plus the total
    of the partitions before it."""
    placed = _placed(df, order, "running")
    totals = placed.groupBy(_PART).agg(*[F.sum(c).alias(f"__t_{c}") for c in value_cols])
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(_PART, *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in value_cols])
    within = Window.partitionBy(_PART).orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(starts), _PART)      # one row per partition of the sort
    for c in value_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"__o_{c}") + F.sum(c).over(within))
    return out.drop(_PART, _MID, *[f"__o_{c}" for c in value_cols])
