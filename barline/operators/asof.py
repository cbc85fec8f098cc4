"""As-of join in bulk: for each row the nearest row before or after it by time, of its own key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def months(time: Column) -> Column:
    """Cuts a key's time line into months."""
    return F.date_trunc("month", time)


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], forward: bool = False, strict: bool = True, cut: Callable[[Column], Column] = months) -> DataFrame:
    """left with ``values`` of the last row of right before it (forward: of the first after it); strict leaves out
    rows of the same time.  Among rows of right that tie in time the greatest values count (forward: the least).
    A left row whose key or time is null has no values.

    Both sides are united and sorted once, and the last value is carried along.  A key's time line is cut into
    stretches, and a stretch takes over what the one before it ends with; that is one small row for each
    stretch, combined before the shuffle.  So neither side is broadcast, and a key with very many rows is as
    many tasks as it has stretches.
    """
    one = F.struct(*[F.col(c) for c in values])
    mine = left.select(*by, F.col(left_time).alias("__time"), F.struct(*left.columns).alias("__row"))
    theirs = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*by, right_time))).select(*by, F.col(right_time).alias("__time"), one.alias("__value"))
    both = mine.unionByName(theirs, allowMissingColumns=True).withColumn("__part", cut(F.col("__time")))
    # Of equal times, what is to be seen comes first.
    side = F.when(F.col("__row").isNull(), 1 if strict else 0).otherwise(0 if strict else 1)
    way = F.desc if forward else F.asc
    order = (way("__time"), side, way("__value"))

    ends = both.select(*by, "__part", F.when(F.col("__row").isNull(), F.struct("__time", "__value")).alias("__end"))
    ends = ends.groupBy(*by, "__part").agg((F.min if forward else F.max)("__end").alias("__end"))
    earlier = W.partitionBy(*by).orderBy(way("__part")).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*by, "__part", F.last("__end", ignorenulls=True).over(earlier)["__value"].alias("__carried"))

    upto = W.partitionBy(*by, "__part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = both.withColumn("__seen", F.last("__value", ignorenulls=True).over(upto)).where("__row IS NOT NULL AND __time IS NOT NULL")
    found = rows.join(carried, [*by, "__part"], "left").select("__row", F.coalesce("__seen", "__carried").alias("__found"))
    found = found.unionByName(left.where(F.col(left_time).isNull()).select(F.struct(*left.columns).alias("__row")), allowMissingColumns=True)
    return found.select("__row.*", *[F.col("__found")[c].alias(c) for c in values])
