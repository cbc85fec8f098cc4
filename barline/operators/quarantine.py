"""Rejected rows with the reason, one for each key and source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.timeunits import MARKET_TZ
from ..plans.rules import BAR_RULES, NEWS_RULES, all_valid, rejection_reason
from .dedup import news_quarantine_winner, quarantine_winner


def rejected(df: DataFrame, rules: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Rows that break a rule, with rejection_reason. Filtered before any shuffle."""
    return df.where(~all_valid(rules, strict)).withColumn("rejection_reason", rejection_reason(rules, strict))


def bar_quarantine(bars: DataFrame, strict: bool = False) -> DataFrame:
    return quarantine_winner(rejected(bars, BAR_RULES, strict))


def news_quarantine(news: DataFrame) -> DataFrame:
    kept = news_quarantine_winner(rejected(news, NEWS_RULES))
    published = F.from_utc_timestamp(F.try_to_timestamp(F.col("published_utc")), MARKET_TZ)
    return kept.withColumn("published_date", F.to_date(published))


def reason_counts(quarantine: DataFrame, date: str = "date") -> DataFrame:
    return quarantine.groupBy(date, "rejection_reason").agg(F.count(F.lit(1)).alias("rows"))
