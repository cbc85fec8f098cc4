"""Dimensions from the latest snapshot of reference tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.classify import SECTOR_OF_SIC, cap_tier, industry, sector

FUTURE_DAYS = 7


def latest_snapshot(table: DataFrame, today: dt.date | None = None, column: str = "snapshot_date") -> DataFrame:
    """Rows of the latest snapshot. The date is found first, so that the filter prunes partitions.

    An empty table is an error, and so is a snapshot dated more than a week ahead.
    """
    newest = table.agg(F.max(column)).first()[0]
    if newest is None:
        raise ValueError(f"no snapshot: {column} is empty")
    if newest > (today or dt.date.today()) + dt.timedelta(days=FUTURE_DAYS):
        raise ValueError(f"snapshot of {newest} lies in the future")
    return table.where(F.col(column) == F.lit(newest))


def ticker_dimension(details: DataFrame, sectors: Mapping[str, str] = SECTOR_OF_SIC) -> DataFrame:
    """One row for each symbol of a snapshot. Inactive symbols and those without an exchange stay."""
    return details.select(
        "symbol",
        F.col("name").alias("company_name"),
        "type",
        sector(F.col("sic_code"), F.col("type"), sectors).alias("sector"),
        industry(F.col("sic_description"), F.col("type")).alias("industry"),
        F.col("primary_exchange").alias("exchange"),
        cap_tier(F.col("market_cap")).alias("market_cap_category"),
        F.col("active").alias("is_active"),
        F.try_to_date("list_date").alias("list_date") if hasattr(F, "try_to_date") else F.expr("CAST(try_to_timestamp(list_date) AS DATE)").alias("list_date"),
    )


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have: Spark keeps no primary keys, so this is the check."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def missing_parents(child: DataFrame, parent: DataFrame, *keys: str) -> DataFrame:
    """Key values of child without a row in parent: the check of a foreign key."""
    return child.select(*keys).distinct().join(parent.select(*keys), list(keys), "left_anti")
