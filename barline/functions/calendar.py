"""NYSE calendar by rule: holidays, early closes, sessions, option expiries, and the market clock."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from .timeunits import MARKET_TZ

OPEN = dt.time(9, 30)
CLOSE = dt.time(16, 0)
EARLY_CLOSE = dt.time(13, 0)
#: Bars are delayed: streams run this long after the close.
SHUTDOWN_DELAY = dt.timedelta(minutes=20)
#: Closures that no rule gives.
EXTRA_CLOSURES = frozenset(
    map(dt.date.fromisoformat, ("2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09"))
)
_DAY = dt.timedelta(days=1)


def _nth(year: int, month: int, weekday: int, n: int) -> dt.date:
    first = dt.date(year, month, 1)
    return first + dt.timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))


def _last(year: int, month: int, weekday: int) -> dt.date:
    end = (dt.date(year, month, 28) + 4 * _DAY).replace(day=1) - _DAY
    return end - dt.timedelta(days=(end.weekday() - weekday) % 7)


def _easter(year: int) -> dt.date:
    """Gregorian Easter Sunday, by the anonymous computus."""
    a, b, c = year % 19, year // 100, year % 100
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    k = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    m = (a + 11 * h + 22 * k) // 451
    month, day = divmod(h + k - 7 * m + 114, 31)
    return dt.date(year, month, day + 1)


def _observed(day: dt.date) -> dt.date | None:
    """A holiday on Sunday moves to Monday, one on Saturday to Friday."""
    return day + _DAY if day.weekday() == 6 else day - _DAY if day.weekday() == 5 else day


@lru_cache(maxsize=None)
def holidays(year: int) -> frozenset[dt.date]:
    new_year = dt.date(year, 1, 1)
    days = {
        # A New Year's Day on Saturday is not made up for: the Friday is in the old year.
        new_year + _DAY if new_year.weekday() == 6 else new_year,
        _nth(year, 2, 0, 3),
        _easter(year) - 2 * _DAY,
        _last(year, 5, 0),
        _observed(dt.date(year, 7, 4)),
        _nth(year, 9, 0, 1),
        _nth(year, 11, 3, 4),
        _observed(dt.date(year, 12, 25)),
    }
    if year >= 1998:
        days.add(_nth(year, 1, 0, 3))
    if year >= 2022:
        days.add(_observed(dt.date(year, 6, 19)))
    return frozenset(days | {d for d in EXTRA_CLOSURES if d.year == year})


def is_trading_day(day: dt.date) -> bool:
    return day.weekday() < 5 and day not in holidays(day.year)


@lru_cache(maxsize=None)
def early_closes(year: int) -> frozenset[dt.date]:
    """Trading days that end at 13:00: after Thanksgiving, Christmas Eve, and 3 July before a holiday on a weekday."""
    days = {_nth(year, 11, 3, 4) + _DAY, dt.date(year, 12, 24)}
    if dt.date(year, 7, 4).weekday() in (1, 2, 3, 4):
        days.add(dt.date(year, 7, 3))
    return frozenset(d for d in days if is_trading_day(d))


def close_time(day: dt.date) -> dt.time:
    return EARLY_CLOSE if day in early_closes(day.year) else CLOSE


def trading_days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [d for d in (first + k * _DAY for k in range((last - first).days + 1)) if is_trading_day(d)]


def option_expiries(first: dt.date, last: dt.date) -> list[dt.date]:
    """Third Fridays between two dates; on a holiday, the trading day before, a week back at most."""
    out = []
    for month in range(first.year * 12 + first.month - 1, last.year * 12 + last.month):
        third = _nth(month // 12, month % 12 + 1, 4, 3)
        day = next((d for d in (third - k * _DAY for k in range(8)) if is_trading_day(d)), None)
        if day and first <= day <= last:
            out.append(day)
    return out


def shutdown_time(now: dt.datetime) -> dt.datetime:
    """When streams stop on the day of now, which is in exchange time."""
    return dt.datetime.combine(now.date(), close_time(now.date()), now.tzinfo) + SHUTDOWN_DELAY


def is_market_hours(now: dt.datetime) -> bool:
    """From 09:30 up to, not including, the close of a trading day."""
    return is_trading_day(now.date()) and OPEN <= now.time() < close_time(now.date())


def should_stop_streaming(now: dt.datetime) -> bool:
    return not is_trading_day(now.date()) or now >= shutdown_time(now)


def market_now() -> dt.datetime:
    return dt.datetime.now(ZoneInfo(MARKET_TZ))


def poll_seconds(remaining: float) -> int:
    """How long to sleep between looks at a stream, by the seconds to its end."""
    return 300 if remaining > 1800 else 60 if remaining > 300 else 10


def sessions(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """(date, close_hhmm) of each trading day: a few thousand rows at most for any span of years."""
    rows = [(d, close_time(d).hour * 100 + close_time(d).minute) for d in trading_days(first, last)]
    return spark.createDataFrame(rows, "date date, close_hhmm int")


def early_close_sessions(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    days = [d for y in range(first.year, last.year + 1) for d in sorted(early_closes(y)) if first <= d <= last]
    return spark.createDataFrame([(d, 1300) for d in days], "date date, close_hhmm int")


def dim_date(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """The date dimension, one row a day."""
    days = spark.createDataFrame([(d,) for d in trading_days(first, last)], "date date").withColumn("is_trading_day", F.lit(True))
    expiries = spark.createDataFrame([(d,) for d in option_expiries(first, last)], "date date").withColumn("is_options_expiry", F.lit(True))
    dates = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    dates = dates.join(F.broadcast(days), "date", "left").join(F.broadcast(expiries), "date", "left")
    weekday, month_end = F.dayofweek("date"), F.col("date") == F.last_day("date")
    return dates.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        weekday.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.weekofyear("date").alias("week_of_year"),
        F.date_format("date", "MMMM").alias("month_name"),
        weekday.isin(1, 7).alias("is_weekend"),
        month_end.alias("is_month_end"),
        (month_end & (F.month("date") % 3 == 0)).alias("is_quarter_end"),
        F.coalesce("is_options_expiry", F.lit(False)).alias("is_options_expiry"),
        F.coalesce("is_trading_day", F.lit(False)).alias("is_trading_day"),
    )
