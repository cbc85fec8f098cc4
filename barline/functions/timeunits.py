"""Epoch units, market time and relative date ranges."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window as W, functions as F

MARKET_TZ = "America/New_York"
#: Units that an epoch column may be in. Any other gives null, which an expectation catches.
PER_SECOND = {"s": 1, "ms": 1_000, "ns": 1_000_000_000}
#: Days that a chart reads for a span, so that near spans share a cached result.
SHORT_FETCH_DAYS, LONG_FETCH_DAYS, FETCH_STEP_DAYS = 420, 1875, 90


def floor_div(value: Column, by: int) -> Column:
    """Whole-number division, downwards, without a detour through doubles."""
    value = value.cast("long")
    return F.call_function("div", value - F.pmod(value, F.lit(by).cast("long")), F.lit(by))


def epoch_seconds(value: Column, unit: Column) -> Column:
    """Whole seconds of an epoch in the unit that another column names; null for an unknown unit."""
    out = F.lit(None).cast("long")
    for name, per in PER_SECOND.items():
        out = F.when(unit == name, floor_div(value, per)).otherwise(out)
    return out


def market_time(seconds: Column, tz: str = MARKET_TZ) -> Column:
    """Wall-clock time on the exchange, as a timestamp that shows it in a UTC session."""
    return F.from_utc_timestamp(F.timestamp_seconds(seconds), tz)


def market_date(value: Column, unit: Column, tz: str = MARKET_TZ) -> Column:
    """Trading date of an epoch: always the exchange's date, never that of UTC."""
    return F.to_date(market_time(epoch_seconds(value, unit), tz))


def hhmm(local: Column) -> Column:
    """Hour and minute as a number, 930 for half past nine."""
    return F.hour(local) * 100 + F.minute(local)


def millis_of(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp with or without time zone, read as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def epoch_window(day: str, start: str, end: str, tz: str = MARKET_TZ) -> tuple[int, int]:
    """[start, end) of a window on a session date in epoch milliseconds; daylight saving is in force
    where the zone says so."""
    date = dt.date.fromisoformat(day)
    try:
        low, high = (dt.datetime.strptime(x, "%H:%M").time() for x in (start, end))
    except ValueError as bad:
        raise ValueError(f"times are HH:MM in 24 hours, not {start!r} and {end!r}") from bad
    if low >= high:
        raise ValueError(f"{start} is not before {end}")
    zone = ZoneInfo(tz)
    return tuple(int(dt.datetime.combine(date, t, zone).timestamp() * 1000) for t in (low, high))


def parsed_timestamp(text: Column) -> Column:
    """A timestamp from text; null where the text is none, also under ANSI mode."""
    return F.try_to_timestamp(text)


def normalised_market_time(value: Column) -> Column:
    """Exchange time of a value that is epoch milliseconds as text, or a timestamp as text; else null."""
    as_number = F.timestamp_millis(value.try_cast("long"))
    return F.from_utc_timestamp(F.coalesce(as_number, F.try_to_timestamp(value)), MARKET_TZ)


def relative_range(name: str, today: dt.date) -> tuple[dt.date, dt.date]:
    """First and last date of a named range: '30 days', 'ytd', 'mtd', 'this quarter', 'last quarter'."""
    quarter = dt.date(today.year, 3 * ((today.month - 1) // 3) + 1, 1)
    if name == "ytd":
        return dt.date(today.year, 1, 1), today
    if name == "mtd":
        return today.replace(day=1), today
    if name == "this quarter":
        return quarter, today
    if name == "last quarter":
        end = quarter - dt.timedelta(days=1)
        return dt.date(end.year, 3 * ((end.month - 1) // 3) + 1, 1), end
    count, _, unit = name.partition(" ")
    if unit not in ("day", "days") or not count.isdigit():
        raise ValueError(f"not a range: {name!r}")
    return today - dt.timedelta(days=int(count)), today


def fetch_days(span: int) -> int:
    """Days to read for a chart of span days: two common sizes, beyond them multiples of 90."""
    for size in (SHORT_FETCH_DAYS, LONG_FETCH_DAYS):
        if span <= size:
            return size
    return -(-span // FETCH_STEP_DAYS) * FETCH_STEP_DAYS


def date_series(spark, first: str, last: str) -> DataFrame:
    """One row for each date from first to last."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.expr("interval 1 day"))).alias("date"))


def missing_dates(dates: DataFrame, column: str = "date", by: tuple[str, ...] = ()) -> DataFrame:
    """Dates between consecutive dates that have no row: the breaks of a chart's axis."""
    w = W.partitionBy(*by).orderBy(column)
    gaps = dates.select(*by, column).distinct().withColumn("before", F.lag(column).over(w))
    gaps = gaps.where(F.datediff(column, "before") > 1)
    return gaps.select(*by, F.explode(F.sequence(F.date_add("before", 1), F.date_sub(F.col(column), 1))).alias(column))
