"""Fact tables: bars of a retention window, adjusted bars, news by symbol, orphan checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from .metrics import daily_metrics
from .splits import adjusted

DAILY_DAYS, MINUTE_DAYS, LEAST_MINUTE_DAYS = 400, 5, 5
DESCRIPTION_CHARS = 500


def recent(df: DataFrame, as_of: dt.date | Column, days: int, date: str = "date") -> DataFrame:
    """Rows from days before as_of on. The filter is on the bare column, so partitions are pruned."""
    since = as_of - dt.timedelta(days=days) if isinstance(as_of, dt.date) else F.date_sub(as_of, days)
    return df.where(F.col(date) >= (F.lit(since) if isinstance(since, dt.date) else since))


def since_latest(df: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Rows from days before the latest date of df on. The date is a scalar, so partitions are pruned."""
    latest = df.agg(F.max(date)).scalar()
    return df.where(F.col(date) >= F.date_sub(latest, days))


def with_lineage(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Adds when and in which run the rows were made; one id for the whole run."""
    return df.withColumn("processing_timestamp", F.current_timestamp()).withColumn("correlation_id", F.lit(run_id or str(uuid.uuid4())))


def daily_fact(daily: DataFrame, as_of: dt.date | Column, days: int = DAILY_DAYS) -> DataFrame:
    return recent(daily, as_of, days).select("symbol", "date", "open", "high", "low", "close", "volume")


def minute_fact(bars: DataFrame, as_of: dt.date | Column, days: int = MINUTE_DAYS) -> DataFrame:
    if days < LEAST_MINUTE_DAYS:
        raise ValueError(f"minute bars are kept for {LEAST_MINUTE_DAYS} days at least, not {days}")
    return recent(bars, as_of, days).select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume")


def adjusted_daily_fact(daily: DataFrame, splits: DataFrame) -> DataFrame:
    """Adjusted bars with rolling metrics, which are taken from the rounded adjusted values."""
    return daily_metrics(adjusted(daily, splits))


def adjusted_minute_fact(minutes: DataFrame, splits: DataFrame) -> DataFrame:
    return adjusted(minutes, splits)


def news_fact(news: DataFrame, as_of: dt.date | Column | None = None, days: int = 90) -> DataFrame:
    """(article_id, symbol) rows of cleaned articles: one for each ticker of an article, each pair once, none
    without a symbol. An article without a description has an empty one."""
    rows = news.where("tickers IS NOT NULL")
    if as_of is not None:
        rows = recent(rows, as_of, days, "published_date")
    return (
        rows.select(
            "article_id",
            F.explode("tickers").alias("symbol"),
            "published_date",
            "published_utc",
            F.col("cleaned_title").alias("title"),
            F.substring(F.coalesce("cleaned_description", F.lit("")), 1, DESCRIPTION_CHARS).alias("description"),
            "article_url",
            "publisher_name",
            "author",
        )
        .where("symbol IS NOT NULL")
        .dropDuplicates(["article_id", "symbol"])
    )


def orphan_summary(facts: dict[str, DataFrame], tickers: DataFrame) -> DataFrame:
    """How many rows and symbols of each fact table have no ticker.

    Facts shrink to one row for each symbol before they meet the dimension, so no fact row is joined.
    """
    known = tickers.select("symbol", F.lit(1).alias("__known")).distinct()
    parts = []
    for name, fact in facts.items():
        symbols = fact.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).join(known, "symbol", "left")
        orphan = F.col("__known").isNull()
        parts.append(
            symbols.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
                F.coalesce(F.sum(F.when(orphan, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
                F.count("symbol").alias("total_symbols"),
                F.count(F.when(orphan, F.col("symbol"))).alias("orphan_symbols"),
            ).withColumn("fact_table", F.lit(name))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    pct = lambda a, b: F.round(F.try_divide(F.lit(100.0) * F.col(a), F.col(b)), 3)
    return out.select(
        "fact_table", "total_rows", "orphan_rows", pct("orphan_rows", "total_rows").alias("orphan_row_pct"),
        "total_symbols", "orphan_symbols", pct("orphan_symbols", "total_symbols").alias("orphan_symbol_pct"),
    )


def orphan_symbols(fact: DataFrame, tickers: DataFrame, date: str = "date", limit: int = 100) -> DataFrame:
    """Symbols of a fact without a ticker, those with most rows first."""
    each = fact.groupBy("symbol").agg(F.count(F.lit(1)).alias("fact_rows"), F.min(date).alias("first_seen"), F.max(date).alias("last_seen"))
    return each.join(tickers.select("symbol"), "symbol", "left_anti").orderBy(F.desc("fact_rows"), "symbol").limit(limit)
