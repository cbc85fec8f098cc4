"""Mergeable sketches: distinct counts of any range of days, and exact percentiles without a sort of all values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import scratch_folder

#: 2**LG registers; the standard error of an estimate is about 1.04 / sqrt(2**LG), 1.6 %.
LG = 12
#: Size of a quantile sketch; ranks are off by about 1.65 / K at most, with a confidence of 99 %.
K = 4000


def daily_sketches(rows: DataFrame, value: str, day: str = "date", lg: int = LG) -> DataFrame:
    """(day, sketch, rows): a sketch of the distinct values of each day. A day that is read again replaces its own."""
    return rows.groupBy(day).agg(F.hll_sketch_agg(value, F.lit(lg)).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def distinct_count(sketch: str | Column = "sketch") -> Column:
    """Distinct values of all days of a group, from their sketches: an aggregate."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def relative_error(lg: int = LG, sigmas: float = 4.0) -> float:
    """What estimates stay within but for one in some ten thousand."""
    return sigmas * 1.04 / 2 ** (lg / 2)


def exact_percentiles(rows: DataFrame, value: str, shares: list[float], by: tuple[str, ...] = (), k: int = K) -> DataFrame:
    """(by, share, value): the same as ``percentile``, linear between neighbours, in two passes.

    A sketch that merges gives two bounds for each wanted rank.  The second pass counts the values below the
    bounds and looks at those between them only; bounds that the rank turns out to lie outside of, which a sketch
    may give with a small probability, are opened, so the result is exact in any case.  Nulls don't count; a group
    without values has no row.
    """
    rows = rows.select(*by, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL")
    sketch = rows.groupBy(*by).agg(F.kll_sketch_agg_double("__v", F.lit(k)).alias("__s"), F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
    slack = 4.0 / k
    def near(share: float) -> Column:
        at = lambda rank: F.kll_sketch_get_quantile_double("__s", F.lit(rank))
        low = at(share - slack) if share > slack else F.col("__least")
        high = at(share + slack) if share < 1 - slack else F.col("__most")
        return F.struct(F.lit(share).alias("share"), low.alias("__low"), high.alias("__high"))

    bounds = sketch.select(*by, "__n", "__least", "__most", F.inline(F.array(*map(near, shares))))
    bounds = bounds.withColumn("__rank", F.col("share") * (F.col("__n") - 1)).drop("__n")

    def joined(table: DataFrame) -> DataFrame:
        return rows.join(table, list(by)) if by else rows.crossJoin(F.broadcast(table))  # a row for each share

    kept = ["share", "__rank", "__low", "__high", "__least", "__most"]
    counts = joined(bounds).groupBy(*by, *kept).agg(F.count_if(F.col("__v") < F.col("__low")).alias("__below"), F.count_if(F.col("__v") <= F.col("__high")).alias("__upto"))
    above = F.col("__below") <= F.floor("__rank")
    low, below = F.when(above, F.col("__low")).otherwise(F.col("__least")), F.when(above, F.col("__below")).otherwise(F.lit(0))
    high = F.when(F.col("__upto") > F.ceil("__rank"), F.col("__high")).otherwise(F.col("__most"))
    told = counts.select(*by, "share", "__rank", low.alias("__low"), high.alias("__high"), below.alias("__below"))
    # A sketch that is made again may give other bounds, so they are written before they are used.
    path = scratch_folder(rows.sparkSession, "bounds")
    told.write.parquet(path)
    told = rows.sparkSession.read.parquet(path)
    between = joined(told).where(F.col("__v").between(F.col("__low"), F.col("__high"))).groupBy(*by, "share", "__rank", "__below", "__v").agg(F.count(F.lit(1)).alias("__times"))
    between = between.withColumn("__end", F.col("__below") + F.sum("__times").over(W.partitionBy(*by, "share").orderBy("__v")))
    holds = lambda rank: F.max(F.when((rank < F.col("__end")) & (rank >= F.col("__end") - F.col("__times")), F.col("__v")))
    ends = between.groupBy(*by, "share").agg(holds(F.floor("__rank")).alias("__a"), holds(F.ceil("__rank")).alias("__b"), F.first("__rank").alias("__rank"))
    part = F.col("__rank") - F.floor("__rank")
    # The way Spark's own percentile weighs the two neighbours.
    return ends.select(*by, "share", F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise((F.ceil("__rank") - F.col("__rank")) * F.col("__a") + part * F.col("__b")).alias("value"))
