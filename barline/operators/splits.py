"""Split adjustment: a bar takes the factor of the first split after its date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .asof import as_of

#: Splits up to this estimated size are broadcast, a row for each symbol; beyond it there is a bulk as-of join.
BROADCAST_BYTES = 64 << 20


def split_dimension(snapshot: DataFrame) -> DataFrame:
    """Typed splits with a usable factor, one for each symbol and date: of several, the largest factor."""
    number = lambda c: F.col(c).try_cast("double")
    usable = snapshot.where(number("historical_adjustment_factor") > 0)
    told = F.struct((-number("historical_adjustment_factor")).alias("least"), number("split_from").alias("split_from"), number("split_to").alias("split_to"), "adjustment_type")
    best = usable.groupBy("symbol", F.col("execution_date").try_cast("date").alias("execution_date")).agg(F.min(told).alias("best"))
    return best.select("symbol", "execution_date", "best.split_from", "best.split_to", "best.adjustment_type", (-F.col("best.least")).alias("historical_adjustment_factor"))


def _timelines(splits: DataFrame) -> DataFrame:
    """(symbol, timeline): all splits of a symbol, which are few, by date."""
    event = F.struct("execution_date", F.col("historical_adjustment_factor").alias("factor"))
    return splits.where("execution_date IS NOT NULL").groupBy("symbol").agg(F.sort_array(F.collect_list(event)).alias("timeline"))


def factor_segments(splits: DataFrame) -> DataFrame:
    """(symbol, valid_from, valid_to, factor): factor holds for dates in [valid_from, valid_to).

    Factors are cumulative: that of a split covers all later ones.  valid_from is null for the unbounded
    past, and dates on or after the last split are in no segment.
    """
    each = _timelines(splits).select("symbol", "timeline", F.posexplode("timeline").alias("nth", "split"))
    before = F.when(F.col("nth") > 0, F.get("timeline", F.col("nth") - 1)["execution_date"])
    return each.select("symbol", before.alias("valid_from"), F.col("split.execution_date").alias("valid_to"), F.col("split.factor").alias("factor"))


def _scaled(bars: DataFrame, columns: list[str], factor: Column) -> DataFrame:
    prices = [F.round(F.col(c) * factor, 6).alias(f"adj_{c}") for c in ("open", "high", "low", "close")]
    volume = F.round(F.col("volume") * (F.lit(1.0) / factor), 0).cast("long").alias("adj_volume")
    return bars.select(*columns, *prices, volume, F.round(factor, 8).alias("price_factor"))


def adjusted(bars: DataFrame, splits: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """bars with adj_open, adj_high, adj_low, adj_close, adj_volume and price_factor; raw columns stay.

    splits is a split dimension.  Small ones are broadcast as one timeline for each symbol, so bars do not move
    and stay one to one; beyond the bound both sides meet in an as-of join, in which a symbol with many bars
    is many tasks.
    """
    if int(splits._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= broadcast_bytes:
        told = bars.join(F.broadcast(_timelines(splits)), "symbol", "left")
        following = F.get(F.filter("timeline", lambda s: s["execution_date"] > F.col("date")), F.lit(0))["factor"]
        return _scaled(told, bars.columns, F.coalesce(following, F.lit(1.0)))
    events = splits.select("symbol", F.col("execution_date").alias("__split"), F.col("historical_adjustment_factor").alias("__factor"))
    told = as_of(bars, events, ["symbol"], "date", "__split", ["__factor"], forward=True)
    return _scaled(told, bars.columns, F.coalesce("__factor", F.lit(1.0)))
