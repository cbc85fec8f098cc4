"""Silver transforms: bars and news from raw to validated, and keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import source_priority
from ..functions.timeunits import MARKET_TZ, epoch_seconds, hhmm, market_time
from ..plans.rules import BAR_RULES, NEWS_RULES, all_valid
from .dedup import BAR_KEY, article_sequence, bar_sequence, upsert_winner

OPEN_HHMM, CLOSE_HHMM = 930, 1600
MIN_DESCRIPTION = 20
OHLCV_LATENESS, NEWS_LATENESS = "10 minutes", "1 hour"


def exchange_traded(bars: DataFrame) -> DataFrame:
    """Without over-the-counter bars; a bar that does not say counts as traded on the exchange."""
    return bars.where(~F.coalesce("otc", F.lit(False)))


def with_lateness(rows: DataFrame, at: Column, lateness: str) -> DataFrame:
    """A watermark on a stream's event time; batch rows stay as they are. As no stateful operator follows,
    it drops nothing: late rows still reach the upsert."""
    if not rows.isStreaming:
        return rows
    return rows.withColumn("__event_time", at).withWatermark("__event_time", lateness).drop("__event_time")


def bars_with_lateness(bars: DataFrame) -> DataFrame:
    return with_lateness(bars, F.timestamp_seconds(epoch_seconds(F.col("start_timestamp"), F.col("ts_unit"))), OHLCV_LATENESS)


def news_with_lateness(news: DataFrame) -> DataFrame:
    return with_lateness(news, F.try_to_timestamp("published_utc"), NEWS_LATENESS)


def unified(*sources: DataFrame) -> DataFrame:
    """Bars of several sources, batch or streaming, in one DataFrame."""
    sources = [bars_with_lateness(s) for s in sources]
    out = exchange_traded(sources[0])
    for s in sources[1:]:
        out = out.unionByName(exchange_traded(s))
    return out


def in_market_hours(bars: DataFrame, early_closes: DataFrame | None = None) -> DataFrame:
    """Bars from 09:30 up to, not including, the close in exchange time.

    early_closes (date, close_hhmm) has a few rows a year and is broadcast; other days close at 16:00.
    """
    local = market_time(epoch_seconds(F.col("start_timestamp"), F.col("ts_unit")))
    at = hhmm(local)
    if early_closes is None:
        return bars.where((at >= OPEN_HHMM) & (at < CLOSE_HHMM))
    closes = F.broadcast(early_closes.select(F.col("date").alias("__day"), F.col("close_hhmm").alias("__close")))
    joined = bars.join(closes, F.to_date(local) == F.col("__day"), "left")
    return joined.where((at >= OPEN_HHMM) & (at < F.coalesce("__close", F.lit(CLOSE_HHMM)))).drop("__day", "__close")


def enriched_bars(bars: DataFrame, early_closes: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Valid bars in market hours, with source_priority and the exchange's date."""
    valid = bars.where(all_valid(BAR_RULES, strict))
    told = valid.withColumn("source_priority", source_priority(F.col("source")))
    told = told.withColumn("date", F.to_date(market_time(epoch_seconds(F.col("start_timestamp"), F.col("ts_unit")))))
    return in_market_hours(told, early_closes)


def silver_bars(enriched: DataFrame) -> DataFrame:
    """One bar for each symbol and minute: the best source's latest version."""
    return upsert_winner(enriched, BAR_KEY, bar_sequence(F.col("source_priority")))


def enriched_news(news: DataFrame) -> DataFrame:
    """Valid articles with the exchange's date of publication and cleaned fields."""
    published = F.from_utc_timestamp(F.try_to_timestamp(F.col("published_utc")), MARKET_TZ)
    cleaned = F.trim(F.coalesce("description", F.lit("")))
    return news.where(all_valid(NEWS_RULES)).select(
        "*",
        F.to_date(published).alias("published_date"),
        F.trim("title").alias("cleaned_title"),
        cleaned.alias("cleaned_description"),
        (F.length(cleaned) >= MIN_DESCRIPTION).alias("has_description"),
        F.col("image_url").isNotNull().alias("has_image"),
        F.coalesce(F.array_size("tickers"), F.lit(0)).alias("tickers_count"),
    )


def silver_news(enriched: DataFrame) -> DataFrame:
    return upsert_winner(enriched, ("article_id",), article_sequence())
