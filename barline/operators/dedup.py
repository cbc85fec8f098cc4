"""Deterministic winners: of a batch, of quarantined rows, and of keyed upserts with a sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.classify import source_priority

BAR_KEY = ("symbol", "start_timestamp")


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The literal comparison lets Spark limit each group before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def latest_ingested(df: DataFrame, keys: Sequence[str] = BAR_KEY) -> DataFrame:
    """One row for each key of a batch: the one ingested last, then ties by what the row says."""
    order = [F.col(c).desc_nulls_last() for c in ("ingestion_timestamp", "processing_timestamp", "correlation_id", "source")]
    return first_of(df, keys, [*order, F.xxhash64(*df.columns).desc()])


def quarantine_winner(df: DataFrame) -> DataFrame:
    """One rejected row for each key and source, chosen by content and not by arrival."""
    seen = ("symbol", "start_timestamp", "source", "open", "high", "low", "close", "volume")
    return first_of(df, (*BAR_KEY, "source"), [F.xxhash64(*seen).desc(), *[F.col(c).desc_nulls_last() for c in seen[3:]]])


def news_quarantine_winner(df: DataFrame) -> DataFrame:
    seen = ("article_id", "title", "article_url", "ingestion_timestamp")
    return first_of(df, ("article_id",), [F.xxhash64(*seen).desc(), *[F.col(c).desc_nulls_last() for c in seen[1:]]])


def payload_hash(columns: Sequence[str] = ("symbol", "start_timestamp", "end_timestamp", "open", "high", "low", "close", "volume", "source")) -> Column:
    """Hash of the payload without its sign."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def bar_sequence(priority: Column | None = None) -> Column:
    """What a later or better version of a bar has more of: source, time of ingestion, then content."""
    priority = source_priority(F.col("source")) if priority is None else priority
    return F.struct(priority.cast("int").alias("priority"), F.col("ingestion_timestamp").cast("timestamp").alias("ingested"), payload_hash().alias("payload"))


def article_sequence() -> Column:
    """Later ingestion wins; equal times are settled by content."""
    return F.struct(F.col("ingestion_timestamp").cast("timestamp").alias("ingested"), F.xxhash64("title", "description", "article_url").alias("payload"))


def upsert_winner(df: DataFrame, keys: Sequence[str], sequence: Column, ignore_nulls: bool = True) -> DataFrame:
    """One row for each key, as a type 1 upsert leaves it after all events, in whatever order they came.

    With ignore_nulls each column has its own latest value that is not null.  This is a plain
    aggregation, so events of a key combine before the shuffle and no state is kept.
    """
    rest = [c for c in df.columns if c not in keys]
    if not ignore_nulls:
        picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), sequence).alias("__row"))
        return picked.select(*keys, "__row.*").select(*df.columns)
    told = df.withColumn("__seq", sequence)
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__seq"))).alias(c) for c in rest]
    return told.groupBy(*keys).agg(*latest).select(*df.columns)
