"""Minute bars to daily bars, in full or for the groups that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def daily_bars(minutes: DataFrame, time: str = "start_timestamp") -> DataFrame:
    """(symbol, date, open, high, low, close, volume). min_by and max_by keep this a hash aggregate."""
    return minutes.groupBy("symbol", "date").agg(
        F.min_by("open", time).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", time).alias("close"),
        F.sum("volume").alias("volume"),
    )


def changed_daily_bars(minutes: DataFrame, changed: DataFrame) -> DataFrame:
    """Daily bars of the (symbol, date) groups of changed, from all their minutes.

    A group is computed afresh, so a change that takes away its highest or first bar is right too.
    """
    keys = changed.select("symbol", "date").distinct()
    return daily_bars(minutes.join(keys, ["symbol", "date"], "left_semi"))


def refreshed(daily: DataFrame, minutes: DataFrame, changed: DataFrame) -> DataFrame:
    """daily with the changed groups replaced; a group without minutes goes."""
    keys = changed.select("symbol", "date").distinct()
    return daily.join(keys, ["symbol", "date"], "left_anti").unionByName(changed_daily_bars(minutes, changed).select(*daily.columns))
