"""Serving queries over the star schema: analyst questions, screener, watchlist, terminal, freshness.

Each takes DataFrames and returns one.  What a report takes from "today" is a parameter, the latest date
of the fact by default.  Every ranking ends in a unique key, so ties do not make results vary.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Hashable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..operators.facts import since_latest
from .rules import UNEXPLAINED_GAP

PRICE_FLOOR = 5.0
DOLLAR_VOLUME_FLOOR = 25_000_000.0
VOLUME_UNIT, VOLUME_RANGE, GAIN_RANGE = 1_000_000, (0.0, 500.0), (-100.0, 300.0)
PAGE_SIZES = (50, 100, 250, 500)
GAINS = {"gain_1w_pct": "close_5d", "gain_1m_pct": "close_21d", "gain_3m_pct": "close_63d", "gain_6m_pct": "close_126d", "gain_1y_pct": "close_252d"}


def change(now: str, before: str) -> Column:
    """Change in percent; null where there is nothing to compare with."""
    return F.try_divide(F.col(now) - F.col(before), F.col(before)) * 100


def _tickers(tickers: DataFrame, *columns: str) -> DataFrame:
    return tickers.select("symbol", *columns)


def _priced(fact: DataFrame) -> DataFrame:
    return fact.where("prev_adj_close > 0")


def latest_day(fact: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the latest date: a scalar in a filter, so other partitions are not read."""
    return fact.where(F.col(date) == fact.agg(F.max(date)).scalar())


def top_movers(fact: DataFrame, tickers: DataFrame, n: int = 20, losers: bool = False) -> DataFrame:
    pct = F.round(change("adj_close", "prev_adj_close"), 2)
    rows = _priced(latest_day(fact)).join(_tickers(tickers, "company_name", "sector"), "symbol")
    rows = rows.select("symbol", "company_name", "sector", "close", pct.alias("price_change_pct"), "volume")
    return rows.orderBy(F.asc("price_change_pct") if losers else F.desc("price_change_pct"), "symbol").limit(n)


def sector_rotation(fact: DataFrame, tickers: DataFrame, dates: DataFrame) -> DataFrame:
    """Mean daily return of each sector by month."""
    rows = _priced(fact).join(_tickers(tickers, "sector").where("sector IS NOT NULL"), "symbol").join(dates.select("date", "year", "month"), "date")
    return rows.groupBy("year", "month", "sector").agg(F.round(F.avg(change("adj_close", "prev_adj_close")), 3).alias("avg_daily_return_pct"), F.count_distinct("symbol").alias("names"))


def volatility_ranking(fact: DataFrame, tickers: DataFrame, days: int = 90, least: int = 30, n: int = 25) -> DataFrame:
    rows = _priced(since_latest(fact, days)).join(_tickers(tickers, "sector"), "symbol")
    each = rows.groupBy("symbol", "sector").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.round(F.avg(F.try_divide(F.col("high") - F.col("low"), F.col("low"))) * 100, 2).alias("avg_daily_range_pct"),
        F.round(F.stddev_samp(change("adj_close", "prev_adj_close")), 2).alias("return_volatility"),
    )
    return each.where(F.col("__rows") >= least).drop("__rows").orderBy(F.desc("return_volatility"), "symbol").limit(n)


def unusual_volume(fact: DataFrame, times: float = 2.0, n: int = 30) -> DataFrame:
    """Volume above a multiple of the mean of up to 20 sessions before."""
    prior = W.partitionBy("symbol").orderBy("date").rowsBetween(-20, -1)
    rows = _priced(fact).select("symbol", "date", F.col("adj_volume").alias("volume"), F.round(change("adj_close", "prev_adj_close"), 2).alias("price_change_pct"), F.avg("adj_volume").over(prior).alias("mean"))
    rows = rows.where(F.col("volume") > times * F.col("mean"))
    return rows.select("symbol", "date", "volume", F.round(F.try_divide("volume", "mean"), 1).alias("volume_x_avg"), "price_change_pct").orderBy(F.desc("volume_x_avg"), "symbol", "date").limit(n)


def momentum(fact: DataFrame, n: int = 25) -> DataFrame:
    """Return over 20 sessions, or since the first session of a younger series."""
    w = W.partitionBy("symbol").orderBy("date")
    rows = fact.select("symbol", "date", "adj_close", F.first("adj_close").over(w.rowsBetween(-20, 0)).alias("then"))
    last = rows.groupBy("symbol").agg(F.max_by(F.struct("adj_close", "then"), "date").alias("x")).where("x.then IS NOT NULL")
    pct = F.round((F.try_divide("x.adj_close", "x.then") - 1) * 100, 2)
    return last.select("symbol", pct.alias("return_20d_pct")).orderBy(F.desc("return_20d_pct"), "symbol").limit(n)


def news_coverage(fact: DataFrame, news: DataFrame, pct: float = 5.0, n: int = 30) -> DataFrame:
    """Days with a move above pct and how many articles there were. Big moves are found before the join."""
    moves = _priced(fact).select("symbol", "date", F.round(change("adj_close", "prev_adj_close"), 2).alias("price_change_pct")).where(F.abs("price_change_pct") > pct)
    told = news.groupBy("symbol", F.col("published_date").alias("date")).agg(F.count("article_id").alias("article_count"))
    rows = moves.join(told, ["symbol", "date"], "left").select("symbol", "date", "price_change_pct", F.coalesce("article_count", F.lit(0)).alias("article_count"))
    return rows.orderBy(F.desc("article_count"), F.desc(F.abs("price_change_pct")), "symbol", "date").limit(n)


def market_breadth(fact: DataFrame, n: int = 30) -> DataFrame:
    up, down = F.count_if(F.col("adj_close") > F.col("prev_adj_close")), F.count_if(F.col("adj_close") < F.col("prev_adj_close"))
    each = _priced(fact).groupBy("date").agg(up.alias("advancers"), down.alias("decliners"))
    return each.withColumn("adv_dec_ratio", F.round(F.try_divide("advancers", "decliners"), 2)).orderBy(F.desc("date")).limit(n)


def overnight_gaps(fact: DataFrame, share: float = 0.03, n: int = 30) -> DataFrame:
    gap = F.try_divide(F.col("adj_open") - F.col("prev_adj_close"), F.col("prev_adj_close"))
    rows = _priced(fact).where(F.abs(gap) > share)
    rows = rows.select("symbol", "date", "prev_adj_close", "adj_open", F.round(gap * 100, 2).alias("gap_pct"), F.round(change("adj_close", "prev_adj_close"), 2).alias("price_change_pct"))
    return rows.orderBy(F.desc("date"), F.desc(F.abs("gap_pct")), "symbol").limit(n)


def intraday_liquidity(minutes: DataFrame) -> DataFrame:
    """Mean volume of a minute bar by hour of exchange time."""
    hour = F.hour(F.from_utc_timestamp(F.timestamp_millis("start_timestamp"), "America/New_York"))
    return minutes.groupBy(hour.alias("et_hour")).agg(F.round(F.avg("volume"), 0).alias("avg_minute_volume"), F.count(F.lit(1)).alias("minute_bars"))


def cap_tier_liquidity(fact: DataFrame, tickers: DataFrame, days: int = 30) -> DataFrame:
    rows = since_latest(fact, days).join(_tickers(tickers, "market_cap_category").where("market_cap_category IS NOT NULL"), "symbol")
    return rows.groupBy("market_cap_category").agg(F.count_distinct("symbol").alias("names"), F.round(F.avg(F.col("close") * F.col("volume")), 0).alias("avg_daily_dollar_volume"))


def screener(fact: DataFrame, tickers: DataFrame, day: dt.date | None = None, floor: float = PRICE_FLOOR) -> DataFrame:
    """The screener's grid on a day: a read of stored metrics, no window."""
    rows = latest_day(fact) if day is None else fact.where(F.col("date") == F.lit(day))
    rows = rows.where(F.col("adj_close") >= floor).join(_tickers(tickers, "company_name", "sector"), "symbol")
    return rows.select(
        "symbol", "company_name", "sector", F.col("adj_close").alias("close"),
        F.round(change("adj_close", "prev_adj_close"), 2).alias("chg_pct"),
        F.round(change("adj_close", "adj_open"), 2).alias("intraday_pct"),
        F.round(change("adj_open", "prev_adj_close"), 2).alias("gap_pct"),
        F.round("rvol_20d", 2).alias("rvol"),
        F.col("adj_volume").alias("volume"),
        F.round(F.col("adj_close") * F.col("adj_volume"), 2).alias("dollar_volume"),
        *[F.round(change("adj_close", then), 2).alias(name) for name, then in GAINS.items()],
    )


def screener_dates(fact: DataFrame, days: int = 90) -> DataFrame:
    return since_latest(fact.select("date").distinct(), days).orderBy(F.desc("date"))


def sectors(tickers: DataFrame) -> DataFrame:
    return tickers.select("sector").where("sector IS NOT NULL").distinct().orderBy("sector")


def volume_range_is_open(volume: tuple[float, float]) -> bool:
    return volume[0] <= VOLUME_RANGE[0] and volume[1] >= VOLUME_RANGE[1]


def filter_screener(
    grid: DataFrame,
    volume: tuple[float, float] = VOLUME_RANGE,
    in_sectors: Sequence[str] = (),
    symbols: Sequence[str] = (),
    gains: Mapping[str, tuple[float, float]] | None = None,
    quick: str | None = None,
) -> DataFrame:
    """The grid under the user's filters. A bound at its limit does not filter, so null gains stay then.

    volume is in millions.  quick is ``breakout`` (relative volume in the top fifth and dollar volume in
    the top three tenths) or ``liquidity`` (dollar volume in the top tenth), both above a floor; the
    percentiles are those of the rows that the other filters leave.
    """
    rows = grid
    if volume[0] > VOLUME_RANGE[0]:
        rows = rows.where(F.col("volume") >= volume[0] * VOLUME_UNIT)
    if volume[1] < VOLUME_RANGE[1]:
        rows = rows.where(F.col("volume") <= volume[1] * VOLUME_UNIT)
    if in_sectors and "All" not in in_sectors:
        rows = rows.where(F.col("sector").isin(*in_sectors))
    if symbols:
        rows = rows.where(F.col("symbol").isin(*symbols))
    for name, (low, high) in (gains or {}).items():
        if name in rows.columns:
            if low > GAIN_RANGE[0]:
                rows = rows.where(F.col(name) >= low)
            if high < GAIN_RANGE[1]:
                rows = rows.where(F.col(name) <= high)
    if quick is None:
        return rows
    marks = {"breakout": (0.80, 0.70), "liquidity": (None, 0.90)}[quick]
    floor = F.lit(DOLLAR_VOLUME_FLOOR)
    cuts = rows.agg((F.percentile("rvol", marks[0]) if marks[0] else F.lit(None).cast("double")).alias("__rvol"), F.percentile("dollar_volume", marks[1]).alias("__dollars"))
    rows = rows.crossJoin(F.broadcast(cuts)).where(F.col("__dollars").isNotNull() & (F.col("dollar_volume") >= F.greatest("__dollars", floor)))
    if marks[0]:
        rows = rows.where(F.col("rvol") >= F.col("__rvol"))
    return rows.drop("__rvol", "__dollars")


def page(rows: DataFrame, sort: str, number: int = 1, size: int = PAGE_SIZES[1], total: int | None = None) -> DataFrame:
    """A page of rows by a column, highest first, nulls last. With total the number is kept in range."""
    if total is not None:
        number = min(max(number, 1), max(math.ceil(total / size), 1))
    order = F.asc("symbol") if sort == "symbol" else F.desc_nulls_last(sort)
    return rows.orderBy(order, "symbol").offset((number - 1) * size).limit(size)


def watchlist_quotes(fact: DataFrame, tickers: DataFrame, symbols: Sequence[str], days: int = 150) -> DataFrame:
    """The latest session of each symbol in the list within days before the fact's latest date."""
    newest = fact.agg(F.max("date")).scalar()
    rows = fact.where(F.col("symbol").isin(*symbols) & (F.col("date") >= F.date_sub(newest, days)))
    kept = ("adj_open", "adj_close", "adj_volume", "prev_adj_close", "rvol_20d", "close_5d", "close_21d", "close_63d")
    last = rows.groupBy("symbol").agg(F.max_by(F.struct(*kept), "date").alias("x")).select("symbol", "x.*").join(_tickers(tickers, "sector"), "symbol")
    return last.select(
        "symbol", "sector", F.col("adj_close").alias("price"),
        F.round(change("adj_close", "prev_adj_close"), 2).alias("chg_pct"),
        F.round(change("adj_close", "adj_open"), 2).alias("intraday_pct"),
        F.round(change("adj_open", "prev_adj_close"), 2).alias("gap_pct"),
        F.round("rvol_20d", 2).alias("rvol"), F.col("adj_volume").alias("volume"),
        F.round(F.col("adj_close") * F.col("adj_volume"), 2).alias("dollar_volume"),
        *[F.round(change("adj_close", GAINS[g]), 2).alias(g) for g in ("gain_1w_pct", "gain_1m_pct", "gain_3m_pct")],
    )


def in_list_order(spark: SparkSession, symbols: Sequence[str], quotes: DataFrame) -> DataFrame:
    """Each symbol of the list with its quote, in the order of the list; null without one."""
    listed = spark.createDataFrame(list(enumerate(symbols)), "position int, symbol string")
    return listed.join(quotes, "symbol", "left").orderBy("position")


def daily_series(fact: DataFrame, symbol: str, since: dt.date | None = None) -> DataFrame:
    """A symbol's adjusted bars under plain names, with the change from the session before."""
    rows = fact.where(F.col("symbol") == symbol)
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since))
    bars = [F.col(f"adj_{c}").alias(c) for c in ("open", "high", "low", "close", "volume")]
    pct = F.when(F.col("prev_adj_close") > 0, change("adj_close", "prev_adj_close"))
    return rows.select("date", *bars, F.col("prev_adj_close").alias("prev_close"), pct.alias("price_change_pct")).orderBy("date")


def intraday(minutes: DataFrame, symbol: str, day: dt.date | None = None) -> DataFrame:
    """A symbol's adjusted minute bars of a day, its latest by default."""
    rows = minutes.where(F.col("symbol") == symbol)
    rows = latest_day(rows) if day is None else rows.where(F.col("date") == F.lit(day))
    bars = [F.col(f"adj_{c}").alias(c) for c in ("open", "high", "low", "close", "volume")]
    return rows.select("start_timestamp", *bars).orderBy("start_timestamp")


def previous_close(fact: DataFrame, symbol: str, before: dt.date) -> DataFrame:
    """The adjusted close of the last session strictly before a date: an as-of lookup."""
    return fact.where((F.col("symbol") == symbol) & (F.col("date") < F.lit(before))).orderBy(F.desc("date")).limit(1).select("date", "adj_close")


def date_ranges(fact: DataFrame) -> DataFrame:
    return fact.groupBy("symbol").agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def recent_news(news: DataFrame, symbol: str, since: dt.date, n: int = 50) -> DataFrame:
    rows = news.where((F.col("symbol") == symbol) & (F.col("published_date") >= F.lit(since)))
    return rows.orderBy(F.desc("published_date"), F.desc("published_utc"), "article_id").limit(n).select("published_date", "title", "publisher_name", "article_url")


def ticker_picker(tickers: DataFrame) -> DataFrame:
    return tickers.select("symbol", "company_name").distinct().orderBy("symbol")


def freshness(daily: DataFrame, minutes: DataFrame) -> DataFrame:
    """Latest daily date, latest minute, and that minute as a label in exchange time."""
    newest = minutes.agg(F.max("start_timestamp").alias("max_start_timestamp"))
    label = F.date_format(F.from_utc_timestamp(F.timestamp_millis("max_start_timestamp"), "America/New_York"), "yyyy-MM-dd HH:mm 'ET'")
    return daily.agg(F.max("date").alias("max_date")).crossJoin(newest).withColumn("minute_label", label)


def recent_rejections(quarantine: DataFrame, days: int = 7, n: int = 100) -> DataFrame:
    return since_latest(quarantine, days).orderBy(F.desc("date"), "symbol", "start_timestamp", "source").limit(n)


def audit_review(log: DataFrame, n: int = 7) -> DataFrame:
    return log.orderBy(F.desc("audit_date")).limit(n)


def unexplained_gaps(fact: DataFrame) -> DataFrame:
    """Adjusted closes that moved by two fifths or more: splits that may be missing."""
    return fact.where(UNEXPLAINED_GAP).select("symbol", "date", "prev_adj_close", "adj_close", F.round(change("adj_close", "prev_adj_close"), 2).alias("change_pct"))


def partition_counts(table: DataFrame, *by: str) -> DataFrame:
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def run_health(fact: DataFrame, n: int = 5) -> DataFrame:
    """What each run wrote: rows, symbols, dates, and when it began."""
    each = fact.groupBy("correlation_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.min("processing_timestamp").alias("started"))
    return each.orderBy(F.desc("started"), "correlation_id").limit(n)


@dataclass
class VersionedCache:
    """Results by query and by the version of the data, which a sentinel query tells; results of old
    versions are released."""

    version_of: Callable[[], Hashable]
    _kept: dict[Hashable, tuple[Hashable, DataFrame]] = field(default_factory=dict)

    def get(self, key: Hashable, build: Callable[[], DataFrame]) -> DataFrame:
        version = self.version_of()
        found = self._kept.get(key)
        if found is not None and found[0] == version:
            return found[1]
        if found is not None:
            found[1].unpersist()
        fresh = build().cache()
        self._kept[key] = (version, fresh)
        return fresh
