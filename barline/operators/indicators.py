"""Chart indicators, trailing statistics and the volume profile, for all symbols at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SHORT, YEAR, DRAWDOWN = 20, 252, 63
VALUE_AREA = 0.70
MIN_BINS, MAX_BINS = 20, 100


def overlays(bars: DataFrame, by: tuple[str, ...] = ("symbol",), time: str = "date") -> DataFrame:
    """Adds sma_20 and vwap over the last 20 rows, fewer at the start."""
    last = W.partitionBy(*by).orderBy(time).rowsBetween(1 - SHORT, 0)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    vwap = F.try_divide(F.sum(typical * F.col("volume")).over(last), F.sum("volume").over(last))
    return bars.select("*", F.avg("close").over(last).alias("sma_20"), vwap.alias("vwap"))


def session_vwap(minutes: DataFrame) -> DataFrame:
    """Adds vwap from the start of each symbol's session."""
    so_far = W.partitionBy("symbol", "date").orderBy("start_timestamp").rowsBetween(W.unboundedPreceding, 0)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return minutes.withColumn("vwap", F.try_divide(F.sum(typical * F.col("volume")).over(so_far), F.sum("volume").over(so_far)))


def trailing_stats(bars: DataFrame) -> DataFrame:
    """One row for each symbol: trailing volume, 52-week range, realised volatility, drawdown, trend.

    A statistic is null unless its whole window is there.  Only the last 252 rows of a symbol are kept
    after one shuffle; all statistics come from them in one aggregation.
    """
    up, down = W.partitionBy("symbol").orderBy("date"), W.partitionBy("symbol").orderBy(F.desc("date"))
    rows = bars.select("symbol", "date", "high", "low", "close", "volume", F.log(F.try_divide(F.col("close"), F.lag("close").over(up))).alias("ret"), F.row_number().over(down).alias("age"))
    rows = rows.where(F.col("age") <= YEAR)
    peak = F.max(F.when(F.col("age") <= DRAWDOWN, F.col("close"))).over(up.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("fall", F.try_divide(F.col("close"), peak) - 1)

    def last(n: int, col: str, first: int = 1) -> Column:
        return F.when(F.col("age").between(first, n + first - 1), F.col(col))

    def whole(n: int, value: Column, col: str, first: int = 1) -> Column:
        return F.when(F.count(last(n, col, first)) == n, value)

    stats = rows.groupBy("symbol").agg(
        F.max_by("close", "date").alias("close"),
        F.max_by("volume", "date").alias("volume"),
        whole(SHORT, F.avg(last(SHORT, "volume", 2)), "volume", 2).alias("avg_vol_20d"),
        whole(YEAR, F.max("high"), "close").alias("high_52w"),
        whole(YEAR, F.min("low"), "close").alias("low_52w"),
        whole(SHORT, F.stddev_samp(last(SHORT, "ret")), "ret").alias("__dev"),
        whole(DRAWDOWN, F.min(last(DRAWDOWN, "fall")), "close").alias("__fall"),
        F.avg(last(SHORT, "close")).alias("sma_20"),
    )
    return stats.select(
        "symbol",
        "avg_vol_20d",
        "high_52w",
        "low_52w",
        (F.try_divide(F.col("close") - F.col("high_52w"), F.col("high_52w")) * 100).alias("pct_from_52w_high"),
        (F.col("__dev") * F.sqrt(F.lit(float(YEAR))) * 100).alias("realized_vol_20d"),
        (F.col("__fall") * 100).alias("max_drawdown_63d"),
        F.when(F.col("avg_vol_20d") > 0, F.col("volume") / F.col("avg_vol_20d")).alias("vol_ratio"),
        (F.try_divide(F.col("close") - F.col("sma_20"), F.col("sma_20")) * 100).alias("pct_from_sma_20"),
    )


def period_summary(bars: DataFrame) -> DataFrame:
    """High, low, mean volume and return from the first to the last close of each symbol's rows."""
    each = bars.groupBy("symbol").agg(
        F.max("high").alias("period_high"),
        F.min("low").alias("period_low"),
        F.min_by("close", "date").alias("first_close"),
        F.max_by("close", "date").alias("last_close"),
        F.avg("volume").alias("avg_volume"),
    )
    return each.withColumn("period_return_pct", F.try_divide(F.col("last_close") - F.col("first_close"), F.col("first_close")) * 100)


def _price_shape(bars: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, price_low, price_high, typical): typical is the exact median range of a bar.

    Ranges are counted first and ranked in a window, which spills, so that no aggregation buffer holds
    the ranges of a busy symbol.
    """
    ranges = bars.groupBy(*by, (F.col("high") - F.col("low")).alias("range")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n"))
    here = W.partitionBy(*by)
    ranges = ranges.withColumn("upto", F.sum("n").over(here.orderBy("range"))).withColumn("all", F.sum("n").over(here))

    def nth(k: Column) -> Column:
        return F.max(F.when((F.col("upto") > k) & (F.col("upto") - F.col("n") <= k), F.col("range")))

    typical = (nth(F.floor((F.col("all") - 1) / 2)) + nth(F.floor(F.col("all") / 2))) / 2
    return ranges.groupBy(*by).agg(F.min("low").alias("price_low"), F.max("high").alias("price_high"), typical.alias("typical"))


def volume_bins(bars: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """(by, n_bins, bin, price_low, bin_size, volume): each bar's volume spread evenly over its price bins.

    A bin is half the median range of a bar, and there are 20 to 100 of them.  Every bin of a profile has
    a row.  Shares are summed as decimals: bins that get the same shares tie whatever the order of rows.
    """
    bars = bars.where("volume > 0 AND high IS NOT NULL AND low IS NOT NULL").select(*by, "high", "low", F.col("volume").cast("double").alias("volume"))
    shape = _price_shape(bars, by)
    span = F.col("price_high") - F.col("price_low")
    shape = shape.where(span > 0).withColumn("typical", F.when(F.col("typical") > 0, F.col("typical")).otherwise(span / 50))
    bins = F.greatest(F.lit(MIN_BINS), F.least(F.lit(MAX_BINS), F.rint(span / (F.col("typical") / 2)).cast("int")))
    shape = shape.withColumn("n_bins", bins).withColumn("bin_size", span / F.col("n_bins"))

    def bin_of(price: str) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("n_bins") - 1, F.floor((F.col(price) - F.col("price_low")) / F.col("bin_size")).cast("int")))

    spread = bars.join(shape, list(by)).withColumn("lo", bin_of("low")).withColumn("hi", bin_of("high"))
    # A bar's share begins at its lowest bin and ends behind its highest: two rows a bar, and a running sum.
    share = (F.col("volume") / (F.col("hi") - F.col("lo") + 1)).cast("decimal(28, 12)")
    change = F.array(F.struct(F.col("lo").alias("bin"), share.alias("share")), F.struct((F.col("hi") + 1).alias("bin"), (-share).alias("share")))
    summed = spread.select(*by, F.inline(change)).groupBy(*by, "bin").agg(F.sum("share").alias("share"))
    every = shape.select(*by, "n_bins", "price_low", "bin_size", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin"))
    running = F.coalesce(F.sum("share").over(W.partitionBy(*by).orderBy("bin")), F.lit(0))
    return every.join(summed, [*by, "bin"], "left").select(*by, "n_bins", "price_low", "bin_size", "bin", running.cast("double").alias("volume"))


def volume_profile(bars: DataFrame, by: tuple[str, ...] = ("symbol",), share: float = VALUE_AREA) -> DataFrame:
    """(by, n_bins, poc_price, value_area_low, value_area_high, value_area_volume, total_volume).

    The value area grows from the bin with most volume, two bins at a time on the side whose next two
    hold more (ties go up), until it holds share of the volume.  A profile has 100 bins at most, so its
    bins travel as one array and the growth is a fold over it.
    """
    rows = volume_bins(bars, by).groupBy(*by, "n_bins", "price_low", "bin_size").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "volume"))), lambda x: x["volume"]).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("total_volume", total).withColumn("poc", (F.array_position("v", F.array_max("v")) - 1).cast("int"))
    rows = rows.where("total_volume > 0")

    def bin_at(i: Column) -> Column:
        return F.when((i >= 0) & (i < F.col("n_bins")), F.element_at("v", F.greatest(F.lit(0), F.least(i, F.col("n_bins") - 1)) + 1)).otherwise(0.0)

    def grow(state: Column, _: Column) -> Column:
        lo, hi, held = state["lo"], state["hi"], state["held"]
        below, above = bin_at(lo - 1) + bin_at(lo - 2), bin_at(hi + 1) + bin_at(hi + 2)
        done = (held >= F.col("total_volume") * share) | ((lo == 0) & (hi == F.col("n_bins") - 1))
        up = ((above >= below) & (hi < F.col("n_bins") - 1)) | (lo == 0)
        higher = F.struct(lo.alias("lo"), F.least(hi + 2, F.col("n_bins") - 1).alias("hi"), (held + above).alias("held"))
        lower = F.struct(F.greatest(lo - 2, F.lit(0)).alias("lo"), hi.alias("hi"), (held + below).alias("held"))
        return F.when(done, state).when(up, higher).otherwise(lower)

    start = F.struct(F.col("poc").alias("lo"), F.col("poc").alias("hi"), F.element_at("v", F.col("poc") + 1).alias("held"))
    rows = rows.withColumn("area", F.aggregate("v", start, grow))
    edge = lambda i: F.col("price_low") + i * F.col("bin_size")
    return rows.select(
        *by,
        "n_bins",
        edge(F.col("poc") + 0.5).alias("poc_price"),
        edge(F.col("area.lo")).alias("value_area_low"),
        edge(F.col("area.hi") + 1).alias("value_area_high"),
        F.col("area.held").alias("value_area_volume"),
        "total_volume",
    )
