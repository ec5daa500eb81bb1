"""Exact places, running sums and last values over data of any size, without one window over a group.

Two levels:

1. the rows are dealt by sampled ranges of (group, order) into about equal parts and written once
   with the number of their range, so a group with a third of all rows (one day of events, one
   conversation) lies in many ranges;
2. integer counts per (group, range) give, as prefix sums, the number of rows of a group in earlier
   ranges.  Ranges are contiguous, so only the first group of a range can have begun before it:
   this table has at most one row per range and is broadcast under that bound;
3. window functions run inside one (range, group) only.

Rows equal in group and whole order share a range; give ``order`` a unique last column where many
rows may tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import written


def numbered(df: DataFrame, order: list[Column], group: tuple[str, ...] = (), place: str = "place",
             sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``place`` (bigint from 1 in ``order`` within ``group``) and, for each ``name:
    column`` of ``sums``, the sum of ``column`` over the earlier rows of the group (0 for the first).

    Null group values form one group.  Columns starting with ``_rk_`` are reserved."""
    sums = sums or {}
    dealt = _dealt(df, order, group)
    totals = dealt.groupBy("_rk_range", *group).agg(
        F.count(F.lit(1)).alias("_rk_n"), *[F.sum(c).alias(f"_rk_s{i}") for i, c in enumerate(sums.values())])
    earlier = _earlier(group)
    carried = totals.select("_rk_range", *group, F.sum("_rk_n").over(earlier).alias("_rk_n"), *[
        F.sum(f"_rk_s{i}").over(earlier).alias(f"_rk_s{i}") for i in range(len(sums))]).filter("_rk_n > 0")
    inside = Window.partitionBy("_rk_range", *group).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return _joined(dealt, F.broadcast(carried), group).select(      # at most one row a range
        *[F.col(f"`{c}`") for c in df.columns],
        (F.row_number().over(inside) + F.coalesce("_rk_n", F.lit(0))).cast("bigint").alias(place),
        *[(F.coalesce(F.sum(c).over(before), F.lit(0)) + F.coalesce(f"_rk_s{i}", F.lit(0))).alias(name)
          for i, (name, c) in enumerate(sums.items())])


def carried_forward(df: DataFrame, order: list[Column], group: tuple[str, ...], value: str, name: str = "latest") -> DataFrame:
    """``df`` with ``name``, the last non-null ``value`` up to and with each row in ``order`` within
    ``group`` (null before the first), by the same two levels."""
    dealt = _dealt(df, order, group)
    inside = Window.partitionBy("_rk_range", *group).orderBy(*order)
    last = (dealt.withColumn("_rk_row", F.row_number().over(inside)).filter(F.col(value).isNotNull())
            .groupBy("_rk_range", *group).agg(F.max_by(value, "_rk_row").alias("_rk_last")))
    every = dealt.select("_rk_range", *group).distinct()
    ends = _joined(every, last, group)
    carried = ends.select("_rk_range", *group, F.last("_rk_last", True).over(_earlier(group)).alias("_rk_last")).filter("_rk_last IS NOT NULL")
    own = F.last(value, True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _joined(dealt, F.broadcast(carried), group).select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(own, "_rk_last").alias(name))


def _dealt(df: DataFrame, order: list[Column], group: tuple[str, ...]) -> DataFrame:
    return written(df.repartitionByRange(*[F.col(g) for g in group], *order)
                   .withColumn("_rk_range", F.spark_partition_id()), "ranges")


def _earlier(group: tuple[str, ...]):
    """The earlier ranges of a group: a window over one small row for each range it lies in."""
    keys = group or (F.lit(0),)
    return Window.partitionBy(*keys).orderBy("_rk_range").rowsBetween(Window.unboundedPreceding, -1)


def _joined(dealt: DataFrame, carried: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """``dealt`` with what its group brings into its range (for most groups nothing)."""
    values = [c for c in carried.columns if c not in ("_rk_range", *group)]
    side = carried.select(F.col("_rk_range").alias("_rk_at"), *[F.col(g).alias(f"_rk_g{i}") for i, g in enumerate(group)], *values)
    same = dealt["_rk_range"] == side["_rk_at"]
    for i, g in enumerate(group):
        same = same & dealt[g].eqNullSafe(side[f"_rk_g{i}"])
    return dealt.join(side, same, "left").drop("_rk_at", *[f"_rk_g{i}" for i in range(len(group))])
