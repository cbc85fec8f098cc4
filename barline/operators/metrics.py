"""Rolling daily metrics, all on one window specification: one shuffle, one sort, one window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

LAGS = {"close_5d": 5, "close_21d": 21, "close_63d": 63, "close_126d": 126, "close_252d": 252}
RVOL_SESSIONS = 20


def daily_metrics(adjusted: DataFrame) -> DataFrame:
    """Adds prev_adj_close, the closes of LAGS sessions ago, and rvol_20d.

    Lags count sessions that are there.  rvol_20d is null unless all 20 sessions before have a volume
    and their mean is above 0.
    """
    w = W.partitionBy("symbol").orderBy("date")
    prior = w.rowsBetween(-RVOL_SESSIONS, -1)
    mean, seen = F.avg("adj_volume").over(prior), F.count("adj_volume").over(prior)
    return adjusted.select(
        "*",
        F.lag("adj_close").over(w).alias("prev_adj_close"),
        *[F.lag("adj_close", n).over(w).alias(name) for name, n in LAGS.items()],
        F.when((seen == RVOL_SESSIONS) & (mean > 0), F.col("adj_volume") / mean).alias("rvol_20d"),
    )


def with_previous_close(df: DataFrame, close: str = "close", alias: str = "prev_close") -> DataFrame:
    return df.withColumn(alias, F.lag(close).over(W.partitionBy("symbol").orderBy("date")))
