"""Daily flat files: paths, probing, reading, mapping to the bronze table, incremental windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timeunits import floor_div, market_date
from ..schemas import FLAT_FILE, HISTORICAL_BRONZE

MINUTE_MS = 60_000


def business_days(first: dt.date, last: dt.date) -> list[dt.date]:
    """Mondays to Fridays; holidays stay, their files are just not there."""
    days = (first + dt.timedelta(days=k) for k in range((last - first).days + 1))
    return [d for d in days if d.weekday() < 5]


def flat_file_paths(first: str, last: str, bucket: str, prefix: str, scheme: str = "s3a") -> list[str]:
    """scheme://bucket/prefix/YYYY/MM/YYYY-MM-DD.csv.gz of each business day; a prefix that repeats the
    bucket is understood."""
    prefix = prefix.strip("/").removeprefix(f"{bucket}/")
    days = business_days(dt.date.fromisoformat(first), dt.date.fromisoformat(last))
    return [f"{scheme}://{bucket}/{prefix}/{d:%Y}/{d:%m}/{d}.csv.gz" for d in days]


def existing(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the files that are there, by metadata only; a pattern gives each
    file that it matches."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        status = at.getFileSystem(conf).globStatus(at)
        pattern = any(c in path for c in "*?[{")
        found += [(s.getPath().toString() if pattern else path, int(s.getModificationTime())) for s in (status or ())]
    return found


def read_flat_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One scan of all files with the declared schema; a malformed row fails it. Gzip files are not split,
    so each is a task. Every row carries its file's modification time as ``file_time``."""
    reader = spark.read.schema(FLAT_FILE).option("header", True).option("mode", "FAILFAST")
    return reader.csv(list(paths)).select("*", F.col("_metadata.file_modification_time").alias("file_time"))


def historical_bars(raw: DataFrame, correlation_id: str, ingested: Column | None = None, source: str = "flatfile") -> DataFrame:
    """Flat-file rows in the shape of the historical table.

    ingestion_timestamp is when the file was published, so that reading it again gives the same sequence.
    Fractions of a share are cut off.
    """
    start = floor_div(F.col("window_start"), 1_000_000)
    out = raw.select(
        F.col("ticker").alias("symbol"),
        F.lit("AM").alias("event_type"),
        "open", "high", "low", "close",
        F.col("volume").cast("long").alias("volume"),
        start.alias("start_timestamp"),
        (start + MINUTE_MS).alias("end_timestamp"),
        F.lit("ms").alias("ts_unit"),
        "transactions",
        F.lit(None).cast("boolean").alias("otc"),
        (F.col("file_time") if ingested is None else ingested).cast("timestamp").alias("ingestion_timestamp"),
        F.current_timestamp().alias("processing_timestamp"),
        F.lit(correlation_id).alias("correlation_id"),
        F.lit(source).alias("source"),
    )
    return out.withColumn("date", market_date(F.col("start_timestamp"), F.col("ts_unit"))).select(*HISTORICAL_BRONZE.names)


@dataclass(frozen=True)
class DateWindow:
    first: dt.date
    last: dt.date
    table_exists: bool

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1

    @property
    def up_to_date(self) -> bool:
        return self.first > self.last


def incremental_window(
    latest: dt.date | None, exists: bool, today: dt.date, lag_days: int = 1, lookback_days: int | None = None, override: tuple[str, str] | None = None
) -> DateWindow:
    """The dates that an incremental load takes: from the day after the table's latest to today less a lag.

    A table without rows, or none, needs lookback_days.  An override of both dates is taken as it is.
    """
    if override and all(override):
        return DateWindow(*map(dt.date.fromisoformat, override), exists)
    if latest is not None:
        first = latest + dt.timedelta(days=1)
    elif lookback_days is None:
        raise ValueError("the table has no rows: lookback_days is needed")
    else:
        first = today - dt.timedelta(days=lookback_days)
    return DateWindow(first, today - dt.timedelta(days=lag_days), exists)
