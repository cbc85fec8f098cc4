"""Named queries over the test tables, each with its DuckDB twin where SQL can say the same."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import testdata as td
from ..functions import calendar, classify, text, timeunits
from ..operators import asof, audit, bloom, dedup, dims, facts, incremental, indicators, metrics, paging, quarantine, rollup, silver, sketches, splits
from ..sources import flatfiles, records, storage
from ..session import scratch_folder
from ..streaming import lateness, lifecycle, messages, upserts
from . import analytics, rules
from .oracles import ADJ_MINUTES, BARS_L, DAILY, DIRTY, FACT, FACTS, NEWS, SPLITS, TICKERS, pct, query, rounded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = dt.date(2001, 11, 4)
WATCHED = ("S1", "S3", "S2", "S999")


def named(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def exact(name: str, n: int) -> Column:
    """A double to n decimals by way of a decimal, as the DuckDB twins do it."""
    return F.round(F.col(name).cast("decimal(28, 10)"), n).cast("double").alias(name)


# ---- inputs, by their place in the star schema


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.daily_bars(td.minute_bars(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.adjusted_daily_fact(daily(spark, sf_dir), splits.split_dimension(td.splits(spark, sf_dir)))


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = td.minute_bars(spark, sf_dir).select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume")
    return facts.adjusted_minute_fact(bars, splits.split_dimension(td.splits(spark, sf_dir)))


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.ticker_dimension(dims.latest_snapshot(td.ticker_details(spark, sf_dir), AS_OF))


def silver_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_news(silver.enriched_news(td.news(spark, sf_dir)))


def news_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.news_fact(silver_news(spark, sf_dir))


# ---- transforms


@named(query(BARS_L, DAILY, select="SELECT * FROM daily"))
def daily_bars(spark, sf_dir):
    return daily(spark, sf_dir)


@named(query(BARS_L, DAILY, select="SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close FROM daily"))
def previous_closes(spark, sf_dir):
    return metrics.with_previous_close(daily(spark, sf_dir))


@named(query(SPLITS, select="SELECT * FROM segments"))
def split_segments(spark, sf_dir):
    return splits.factor_segments(splits.split_dimension(td.splits(spark, sf_dir)))


@named(query(*FACTS, select=f"SELECT * EXCLUDE (rvol_20d), {rounded('rvol_20d', 6)} AS rvol_20d FROM fact"))
def adjusted_daily(spark, sf_dir):
    return fact(spark, sf_dir).withColumn("rvol_20d", exact("rvol_20d", 6))


@named(query(BARS_L, SPLITS, ADJ_MINUTES, select="SELECT * FROM minutes"))
def adjusted_minutes(spark, sf_dir):
    return minutes(spark, sf_dir)


@named(query(TICKERS, select="SELECT * FROM tickers"))
def dim_ticker(spark, sf_dir):
    return tickers(spark, sf_dir)


def traded_span(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dt.date, dt.date]:
    """(date, bars) of the days with bars, and the first and last of them."""
    days = td.minute_bars(spark, sf_dir).groupBy("date").agg(F.count("*").alias("bars"))
    first, last = td.table(spark, sf_dir, "lineitem").agg(F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate"))).first()
    return days, first or AS_OF, last or AS_OF


DAYS = """
counted AS (SELECT date, count(*) AS bars FROM bars GROUP BY 1),
series AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM bars), (SELECT max(date) FROM bars), INTERVAL 1 DAY)) AS DATE) AS date)"""


def _dim_date_sql() -> str:
    first, last = dt.date(1990, 1, 1), dt.date(2005, 12, 31)
    trading = ", ".join(f"DATE '{d}'" for d in calendar.trading_days(first, last))
    expiry = ", ".join(f"DATE '{d}'" for d in calendar.option_expiries(first, last))
    return query(BARS_L, DAYS, select=f"""
    SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
           CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name, CAST(weekofyear(date) AS INTEGER) AS week_of_year, monthname(date) AS month_name,
           dayofweek(date) IN (0, 6) AS is_weekend, date = last_day(date) AS is_month_end, date = last_day(date) AND month(date) % 3 = 0 AS is_quarter_end,
           date IN ({expiry}) AS is_options_expiry, date IN ({trading}) AS is_trading_day, coalesce(bars, 0) AS bars
    FROM series LEFT JOIN counted USING (date)""")  # fmt: skip


@named(_dim_date_sql())
def dim_date(spark, sf_dir):
    """The date dimension over the days of the bars, with the number of bars of each."""
    days, first, last = traded_span(spark, sf_dir)
    return calendar.dim_date(spark, first, last).join(days, "date", "left").withColumn("bars", F.coalesce("bars", F.lit(0)))


@named(query(BARS_L, DAYS, select="SELECT date, coalesce(bars, 0) AS bars FROM series LEFT JOIN counted USING (date)"))
def date_series(spark, sf_dir):
    """Every date from the first bar to the last, also those without bars."""
    days, first, last = traded_span(spark, sf_dir)
    return timeunits.date_series(spark, str(first), str(last)).join(days, "date", "left").select("date", F.coalesce("bars", F.lit(0)).alias("bars"))


@named(query(BARS_L, DAILY, select="""
, g AS (SELECT symbol, date, lag(date) OVER (PARTITION BY symbol ORDER BY date) AS before FROM daily)
SELECT symbol, CAST(unnest(generate_series(before + 1, date - 1, INTERVAL 1 DAY)) AS DATE) AS date FROM g WHERE date - before > 1"""))  # fmt: skip
def range_breaks(spark, sf_dir):
    return timeunits.missing_dates(daily(spark, sf_dir), by=("symbol",))


@named(query(BARS_L, select="""
SELECT symbol, start_timestamp, CAST(start_timestamp // 1000 AS BIGINT) AS seconds, date AS market_date, CAST(strftime(timezone('America/New_York', timezone('UTC', make_timestamp(start_timestamp * 1000))), '%H%M') AS INTEGER) AS hhmm
FROM bars"""))  # fmt: skip
def market_times(spark, sf_dir):
    b = td.minute_bars(spark, sf_dir)
    seconds = timeunits.epoch_seconds(F.col("start_timestamp"), F.col("ts_unit"))
    return b.select("symbol", "start_timestamp", seconds.alias("seconds"), timeunits.market_date(F.col("start_timestamp"), F.col("ts_unit")).alias("market_date"), timeunits.hhmm(timeunits.market_time(seconds)).alias("hhmm"))


EVENTS_E = """
e AS (SELECT upper(event_type) AS symbol, epoch_us(ts) // 1000 AS ms, event_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
ebars AS (
  SELECT symbol, ms - ms % 60000 AS start_timestamp, arg_min(value, (ms, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ms, event_id)) AS close, CAST(sum(k) AS BIGINT) AS volume
  FROM e GROUP BY 1, 2)"""


@named(query(EVENTS_E, select="SELECT * FROM ebars"))
def event_bars(spark, sf_dir):
    return td.event_bars(spark, sf_dir)


@named(query(EVENTS_E, select="""
SELECT *, CAST(timezone('America/New_York', timezone('UTC', make_timestamp(start_timestamp * 1000))) AS DATE) AS date FROM ebars
WHERE CAST(strftime(timezone('America/New_York', timezone('UTC', make_timestamp(start_timestamp * 1000))), '%H%M') AS INTEGER) BETWEEN 930 AND 1559"""))  # fmt: skip
def market_hours(spark, sf_dir):
    early = calendar.early_close_sessions(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    bars = td.event_bars(spark, sf_dir).withColumn("ts_unit", F.lit("ms"))
    bars = bars.withColumn("date", timeunits.market_date(F.col("start_timestamp"), F.col("ts_unit")))
    return silver.in_market_hours(bars, early).drop("ts_unit")


@named(query(BARS_L, select="""
SELECT symbol, date, start_timestamp, open, high, low, close, volume, source, CAST(2 AS INTEGER) AS source_priority FROM bars
WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND low <= high AND open BETWEEN low AND high AND close BETWEEN low AND high AND volume >= 0"""))  # fmt: skip
def silver_upsert(spark, sf_dir):
    rows = silver.unified(td.competing_bars(spark, sf_dir))
    return silver.silver_bars(silver.enriched_bars(rows)).select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume", "source", "source_priority")


@named(query(BARS_L, select="""
SELECT symbol, start_timestamp, CASE WHEN l_orderkey % 5 = 0 THEN close * 1.01::DOUBLE ELSE close END AS close, CASE WHEN l_orderkey % 5 = 0 THEN 'stream' ELSE 'flatfile' END AS source FROM bars"""))  # fmt: skip
def latest_ingested(spark, sf_dir):
    rows = td.competing_bars(spark, sf_dir).withColumn("processing_timestamp", F.lit(None).cast("timestamp")).withColumn("correlation_id", F.lit("r"))
    return dedup.latest_ingested(rows).select("symbol", "start_timestamp", "close", "source")


@named(query(BARS_L, DIRTY, select="""
SELECT symbol, date, start_timestamp, open, high, low, close, volume, source,
       CASE WHEN NOT ok_price THEN 'invalid_price_positive' WHEN NOT ok_logic THEN 'invalid_ohlc_logic' WHEN NOT ok_volume THEN 'invalid_volume' ELSE 'unknown' END AS rejection_reason
FROM judged WHERE NOT (ok_price AND ok_logic AND ok_volume)"""))  # fmt: skip
def bar_quarantine(spark, sf_dir):
    return quarantine.bar_quarantine(td.dirty_bars(spark, sf_dir)).select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume", "source", "rejection_reason")


@named(query(BARS_L, DIRTY, select="""
SELECT date, CASE WHEN NOT ok_price THEN 'invalid_price_positive' WHEN NOT ok_logic THEN 'invalid_ohlc_logic' WHEN NOT ok_volume THEN 'invalid_volume' ELSE 'unknown' END AS rejection_reason, count(*) AS rows
FROM judged WHERE NOT (ok_price AND ok_logic AND ok_volume) GROUP BY 1, 2"""))  # fmt: skip
def rejection_counts(spark, sf_dir):
    return quarantine.reason_counts(quarantine.bar_quarantine(td.dirty_bars(spark, sf_dir)))


@named(query(BARS_L, DIRTY, select="""
SELECT symbol, date, start_timestamp, open, high, low, close, volume, source,
       CASE WHEN NOT ok_price THEN 'invalid_price_positive' WHEN NOT ok_logic THEN 'invalid_ohlc_logic' ELSE 'invalid_volume' END AS rejection_reason
FROM judged WHERE NOT (ok_price AND ok_logic AND ok_volume) AND date >= (SELECT max(date) FROM judged WHERE NOT (ok_price AND ok_logic AND ok_volume)) - 7
ORDER BY date DESC, symbol, start_timestamp, source LIMIT 100"""))  # fmt: skip
def recent_rejections(spark, sf_dir):
    kept = quarantine.bar_quarantine(td.dirty_bars(spark, sf_dir)).select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume", "source", "rejection_reason")
    return analytics.recent_rejections(kept)


@named(query(BARS_L, DIRTY, select="""
, c AS (
  SELECT date AS audit_date, count(*) AS total_count, count(*) FILTER (WHERE NOT (ok_price AND ok_logic AND ok_volume)) AS rejected_count, count(*) FILTER (WHERE NOT ok_price) AS rejected_price_positive,
         count(*) FILTER (WHERE coalesce(ok_price, true) AND NOT ok_logic) AS rejected_ohlc_logic, count(*) FILTER (WHERE coalesce(ok_price AND ok_logic, true) AND coalesce(ok_price, true) AND coalesce(ok_logic, true) AND NOT ok_volume) AS rejected_volume
  FROM judged GROUP BY 1),
s AS (SELECT date, max(n) AS session_bars FROM (SELECT date, symbol, count(*) AS n FROM judged GROUP BY 1, 2) GROUP BY 1)
SELECT c.*, total_count - rejected_count AS valid_count, rejected_count * 100.0::DOUBLE / total_count AS rejection_rate_pct,
       rejected_count * 100.0::DOUBLE / total_count < 1.0 AS quality_gate_passed, rejected_count * 100.0::DOUBLE / total_count >= 0.5 AS quality_gate_warning, session_bars
FROM c JOIN s ON s.date = c.audit_date"""))  # fmt: skip
def audit_log(spark, sf_dir):
    return audit.audit_log(td.dirty_bars(spark, sf_dir))


@named(query(BARS_L, DIRTY, select="""
SELECT 'valid_symbol' AS name, 'fail' AS kind, count(*) AS passed_records, CAST(0 AS BIGINT) AS failed_records FROM judged
UNION ALL SELECT 'has_close', 'warn', count(close), count(*) - count(close) FROM judged
UNION ALL SELECT 'positive', 'drop', count_if(coalesce(ok_price, false)), count_if(NOT coalesce(ok_price, false)) FROM judged"""))  # fmt: skip
def expectation_counts(spark, sf_dir):
    told = (rules.Expectation("valid_symbol", "symbol IS NOT NULL"), rules.Expectation("has_close", "close IS NOT NULL", "warn"), rules.Expectation("positive", rules.BAR_RULES["price_positive"], "drop"))
    return rules.violations(td.dirty_bars(spark, sf_dir), *told)


@named(query(BARS_L, DAILY, select="SELECT * FROM daily"))
def refreshed_daily(spark, sf_dir):
    """Bars of one order status arrive later; only the groups they touch are computed anew."""
    bars = td.minute_bars(spark, sf_dir)
    late = bars.where("l_returnflag = 'R' AND date >= '2001-01-01'")
    before = rollup.daily_bars(bars.join(late.select("symbol", "start_timestamp"), ["symbol", "start_timestamp"], "left_anti"))
    return rollup.refreshed(before, bars, late)


@named(query(BARS_L, select="SELECT symbol, start_timestamp, close FROM bars WHERE l_returnflag <> 'A'"))
def insert_only(spark, sf_dir):
    """What an insert-only merge appends: rows whose key is not there yet."""
    batch = td.minute_bars(spark, sf_dir)
    return storage.unknown_rows(batch, batch.where("l_returnflag = 'A'")).select("symbol", "start_timestamp", "close")


@named(query(BARS_L, select="SELECT symbol, start_timestamp, end_ts AS end_timestamp, date, volume, CAST(NULL AS VARCHAR) AS topic FROM (SELECT *, start_timestamp + 60000 AS end_ts FROM bars)"))
def flat_file_mapping(spark, sf_dir):
    b = td.minute_bars(spark, sf_dir)
    raw = b.select(F.col("symbol").alias("ticker"), (F.col("volume") + 0.5).alias("volume"), "open", "close", "high", "low", (F.col("start_timestamp") * 1_000_000).alias("window_start"), F.lit(1).alias("transactions"))
    rows = flatfiles.historical_bars(raw, "run", F.timestamp_seconds(F.lit(0)))
    from ..schemas import STREAM_BRONZE

    shaped = storage.aligned(rows.drop("ingestion_timestamp"), STREAM_BRONZE)
    return shaped.select("symbol", "start_timestamp", "end_timestamp", "date", "volume", "topic")


@named("""
SELECT upper(event_type) AS symbol, value AS close, CAST(epoch_us(ts) // 1000 AS BIGINT) AS start_timestamp, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ingestion_timestamp, 'stream' AS source
FROM events WHERE event_id % 10 <> 0""")  # fmt: skip
def decoded_messages(spark, sf_dir):
    """Events as messages behind a wire header, of which a tenth cannot be read."""
    e = td.table(spark, sf_dir, "events").withColumn("ms", timeunits.millis_of(F.col("ts")))
    body = F.to_json(F.struct(F.lit("AM").alias("event_type"), F.upper("event_type").alias("symbol"), F.col("value").alias("close"), F.lit(1).alias("volume"), F.col("ms").alias("start_timestamp"), F.col("ms").alias("ingestion_timestamp")))
    body = F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(body)
    sent = e.select(F.lit("k").alias("key"), F.concat(F.lit(bytes(5)), body.cast("binary")).alias("value"), F.lit("bars").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    return messages.split_messages(sent, "run")[0].select("symbol", "close", "start_timestamp", "ingestion_timestamp", "source")


@named("SELECT CAST(event_id AS BIGINT) AS \"offset\", 'undecodable' AS quarantine_reason FROM events WHERE event_id % 10 = 0")
def dead_letters(spark, sf_dir):
    e = td.table(spark, sf_dir, "events")
    body = F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(F.lit("A").alias("symbol"))))
    sent = e.select(F.lit("k").alias("key"), F.concat(F.lit(bytes(5)), body.cast("binary")).alias("value"), F.lit("bars").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    return messages.split_messages(sent, "run")[1].select("offset", "quarantine_reason")


# ---- news


@named(query(NEWS, select="""
SELECT article_id, day AS published_date, trim(title, ' ') AS cleaned_title, length(trim(coalesce(description, ''), ' ')) >= 20 AS has_description,
       image_url IS NOT NULL AS has_image, CAST(len(tickers) AS INTEGER) AS tickers_count FROM silver_news"""))  # fmt: skip
def news_silver(spark, sf_dir):
    return silver_news(spark, sf_dir).select("article_id", "published_date", "cleaned_title", "has_description", "has_image", "tickers_count")


@named(query(NEWS, select="""
SELECT article_id, CASE WHEN dated THEN day END AS published_date, CASE WHEN NOT ok_title THEN 'invalid_title' WHEN NOT ok_url THEN 'invalid_url' ELSE 'invalid_timestamp_order' END AS rejection_reason
FROM checked WHERE NOT (ok_title AND ok_url AND ok_time)"""))  # fmt: skip
def news_quarantine(spark, sf_dir):
    return quarantine.news_quarantine(td.news(spark, sf_dir)).select("article_id", "published_date", "rejection_reason")


@named(query(NEWS, select="SELECT * FROM fact_news WHERE symbol IS NOT NULL"))
def fact_news(spark, sf_dir):
    return news_fact(spark, sf_dir).select("article_id", "symbol", "published_date", "title", "description", "article_url", "author")


@named(query(BARS_L, TICKERS, select="""
SELECT symbol, true AS active FROM tickers WHERE is_active
UNION ALL SELECT DISTINCT symbol, false FROM bars WHERE symbol NOT IN (SELECT symbol FROM tickers WHERE is_active)"""))  # fmt: skip
def ticker_universe(spark, sf_dir):
    return records.ticker_universe(tickers(spark, sf_dir).where("is_active"), daily(spark, sf_dir), None)


# ---- analyst questions


PRICED = "f.prev_adj_close IS NOT NULL AND f.prev_adj_close > 0"


@named(query(*FACTS, TICKERS, select=f"""
SELECT symbol, company_name, sector, close, {pct('adj_close', 'prev_adj_close')} AS price_change_pct, volume
FROM fact f JOIN tickers USING (symbol) WHERE date = (SELECT max(date) FROM fact) AND {PRICED} ORDER BY price_change_pct DESC, symbol LIMIT 20"""))  # fmt: skip
def top_movers(spark, sf_dir):
    return analytics.top_movers(fact(spark, sf_dir), tickers(spark, sf_dir))


@named(query(*FACTS, TICKERS, select=f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, sector,
       {rounded('avg((adj_close - prev_adj_close) / prev_adj_close * 100)', 3)} AS avg_daily_return_pct, count(DISTINCT symbol) AS names
FROM fact f JOIN tickers USING (symbol) WHERE {PRICED} GROUP BY 1, 2, 3"""))  # fmt: skip
def sector_rotation(spark, sf_dir):
    dates = calendar.dim_date(spark, dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    return analytics.sector_rotation(fact(spark, sf_dir), tickers(spark, sf_dir), dates)


@named(query(*FACTS, TICKERS, select=f"""
SELECT symbol, sector, {rounded('avg((high - low) / NULLIF(low, 0)) * 100', 2)} AS avg_daily_range_pct, {rounded('stddev_samp((adj_close - prev_adj_close) / prev_adj_close * 100)', 2)} AS return_volatility
FROM fact f JOIN tickers USING (symbol) WHERE date >= (SELECT max(date) FROM fact) - 400 AND {PRICED}
GROUP BY 1, 2 HAVING count(*) >= 30 ORDER BY return_volatility DESC, symbol LIMIT 25"""))  # fmt: skip
def volatility_ranking(spark, sf_dir):
    return analytics.volatility_ranking(fact(spark, sf_dir), tickers(spark, sf_dir), days=400)


@named(query(*FACTS, select=f"""
, v AS (SELECT symbol, date, adj_volume AS volume, {pct('adj_close', 'prev_adj_close')} AS price_change_pct,
               avg(adj_volume) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS mean FROM fact f WHERE {PRICED})
SELECT symbol, date, volume, {rounded('volume / mean', 1)} AS volume_x_avg, price_change_pct FROM v WHERE volume > 2 * mean ORDER BY volume_x_avg DESC, symbol, date LIMIT 30"""))  # fmt: skip
def unusual_volume(spark, sf_dir):
    return analytics.unusual_volume(fact(spark, sf_dir))


@named(query(*FACTS, select=f"""
, r AS (SELECT symbol, date, adj_close, first_value(adj_close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS since, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM fact)
SELECT symbol, {rounded('(adj_close / NULLIF(since, 0) - 1) * 100', 2)} AS return_20d_pct FROM r WHERE rn = 1 ORDER BY return_20d_pct DESC, symbol LIMIT 25"""))  # fmt: skip
def momentum(spark, sf_dir):
    return analytics.momentum(fact(spark, sf_dir))


@named(query(*FACTS, NEWS, select=f"""
, m AS (SELECT symbol, date, {pct('adj_close', 'prev_adj_close')} AS price_change_pct FROM fact f WHERE {PRICED})
SELECT m.symbol, m.date, price_change_pct, count(n.article_id) AS article_count FROM m LEFT JOIN fact_news n ON n.symbol = m.symbol AND n.published_date = m.date
GROUP BY 1, 2, 3 HAVING abs(price_change_pct) > 5 ORDER BY article_count DESC, abs(price_change_pct) DESC, m.symbol, m.date LIMIT 30"""))  # fmt: skip
def news_coverage(spark, sf_dir):
    return analytics.news_coverage(fact(spark, sf_dir), news_fact(spark, sf_dir))


@named(query(*FACTS, select=f"""
SELECT date, count_if(adj_close > prev_adj_close) AS advancers, count_if(adj_close < prev_adj_close) AS decliners,
       {rounded('count_if(adj_close > prev_adj_close) * 1.0::DOUBLE / NULLIF(count_if(adj_close < prev_adj_close), 0)', 2)} AS adv_dec_ratio
FROM fact f WHERE {PRICED} GROUP BY 1 ORDER BY date DESC LIMIT 30"""))  # fmt: skip
def market_breadth(spark, sf_dir):
    return analytics.market_breadth(fact(spark, sf_dir))


@named(query(*FACTS, select=f"""
SELECT symbol, date, prev_adj_close, adj_open, {pct('adj_open', 'prev_adj_close')} AS gap_pct, {pct('adj_close', 'prev_adj_close')} AS price_change_pct
FROM fact f WHERE {PRICED} AND abs((adj_open - prev_adj_close) / prev_adj_close) > 0.03 ORDER BY date DESC, abs(gap_pct) DESC, symbol LIMIT 30"""))  # fmt: skip
def overnight_gaps(spark, sf_dir):
    return analytics.overnight_gaps(fact(spark, sf_dir))


@named(query(EVENTS_E, select=f"""
SELECT CAST(hour(timezone('America/New_York', timezone('UTC', make_timestamp(start_timestamp * 1000)))) AS INTEGER) AS et_hour, {rounded('avg(volume)', 0)} AS avg_minute_volume, count(*) AS minute_bars
FROM ebars GROUP BY 1"""))  # fmt: skip
def intraday_liquidity(spark, sf_dir):
    return analytics.intraday_liquidity(td.event_bars(spark, sf_dir))


@named(query(*FACTS, TICKERS, select=f"""
SELECT market_cap_category, count(DISTINCT symbol) AS names, {rounded('avg(close * volume)', 0)} AS avg_daily_dollar_volume
FROM fact JOIN tickers USING (symbol) WHERE date >= (SELECT max(date) FROM fact) - 30 GROUP BY 1"""))  # fmt: skip
def cap_tier_liquidity(spark, sf_dir):
    return analytics.cap_tier_liquidity(fact(spark, sf_dir), tickers(spark, sf_dir))


# ---- screener, watchlist, terminal


GRID = f"""
grid AS (
  SELECT symbol, company_name, sector, adj_close AS close, {pct('adj_close', 'prev_adj_close')} AS chg_pct, {pct('adj_close', 'adj_open')} AS intraday_pct, {pct('adj_open', 'prev_adj_close')} AS gap_pct,
         {rounded('rvol_20d', 2)} AS rvol, adj_volume AS volume, {rounded('adj_close * adj_volume', 2)} AS dollar_volume, {pct('adj_close', 'close_5d')} AS gain_1w_pct, {pct('adj_close', 'close_21d')} AS gain_1m_pct,
         {pct('adj_close', 'close_63d')} AS gain_3m_pct, {pct('adj_close', 'close_126d')} AS gain_6m_pct, {pct('adj_close', 'close_252d')} AS gain_1y_pct
  FROM fact JOIN tickers USING (symbol) WHERE date = DATE '2001-06-15' AND adj_close >= 5.0)"""
GRID_DAY = dt.date(2001, 6, 15)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.screener(fact(spark, sf_dir), tickers(spark, sf_dir), GRID_DAY)


@named(query(*FACTS, TICKERS, GRID, select="SELECT * FROM grid"))
def screener(spark, sf_dir):
    return grid(spark, sf_dir)


@named(query(*FACTS, select="SELECT DISTINCT date FROM fact WHERE date >= (SELECT max(date) FROM fact) - 90"))
def screener_dates(spark, sf_dir):
    return analytics.screener_dates(fact(spark, sf_dir))


@named(query(TICKERS, select="SELECT DISTINCT sector FROM tickers WHERE sector IS NOT NULL"))
def screener_sectors(spark, sf_dir):
    return analytics.sectors(tickers(spark, sf_dir))


@named(query(*FACTS, TICKERS, GRID, select="SELECT * FROM grid WHERE volume >= 0.001 * 1000000 AND sector IN ('Energy', 'Transportation', 'Manufacturing', 'Mining', 'Retail') AND gain_1m_pct >= -50"))
def screener_filtered(spark, sf_dir):
    return analytics.filter_screener(grid(spark, sf_dir), (0.001, 500.0), ("Energy", "Transportation", "Manufacturing", "Mining", "Retail"), gains={"gain_1m_pct": (-50.0, 300.0)})


@named(query(*FACTS, TICKERS, GRID, select="""
SELECT * FROM grid WHERE rvol >= (SELECT quantile_cont(rvol, 0.8) FROM grid) AND dollar_volume >= greatest((SELECT quantile_cont(dollar_volume, 0.7) FROM grid), 25000000.0)"""))  # fmt: skip
def screener_breakout(spark, sf_dir):
    return analytics.filter_screener(grid(spark, sf_dir), quick="breakout")


@named(query(*FACTS, TICKERS, GRID, select="SELECT * FROM grid WHERE dollar_volume >= greatest((SELECT quantile_cont(dollar_volume, 0.9) FROM grid), 25000000.0)"))
def screener_liquidity(spark, sf_dir):
    return analytics.filter_screener(grid(spark, sf_dir), quick="liquidity")


@named(query(*FACTS, TICKERS, GRID, select="SELECT * FROM grid ORDER BY rvol DESC NULLS LAST, symbol LIMIT 10 OFFSET 10"))
def screener_page(spark, sf_dir):
    return analytics.page(grid(spark, sf_dir), "rvol", number=2, size=10)


@named(query(*FACTS, TICKERS, select=f"""
, latest AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM fact WHERE symbol IN ('S1', 'S3', 'S2', 'S999') AND date >= (SELECT max(date) FROM fact) - 150)
SELECT symbol, sector, adj_close AS price, {pct('adj_close', 'prev_adj_close')} AS chg_pct, {pct('adj_close', 'adj_open')} AS intraday_pct, {pct('adj_open', 'prev_adj_close')} AS gap_pct, {rounded('rvol_20d', 2)} AS rvol,
       adj_volume AS volume, {rounded('adj_close * adj_volume', 2)} AS dollar_volume, {pct('adj_close', 'close_5d')} AS gain_1w_pct, {pct('adj_close', 'close_21d')} AS gain_1m_pct, {pct('adj_close', 'close_63d')} AS gain_3m_pct
FROM latest JOIN tickers USING (symbol) WHERE rn = 1"""))  # fmt: skip
def watchlist_quotes(spark, sf_dir):
    return analytics.watchlist_quotes(fact(spark, sf_dir), tickers(spark, sf_dir), WATCHED)


@named(query(TICKERS, select="SELECT CAST(i AS INTEGER) AS position, s.symbol, sector FROM (SELECT unnest([0, 1, 2, 3]) AS i, unnest(['S1', 'S3', 'S2', 'S999']) AS symbol) s LEFT JOIN tickers USING (symbol)"))
def watchlist_order(spark, sf_dir):
    return analytics.in_list_order(spark, WATCHED, tickers(spark, sf_dir).select("symbol", "sector")).select("position", "symbol", "sector")


@named(query(*FACTS, select=f"""
SELECT date, adj_open AS open, adj_high AS high, adj_low AS low, adj_close AS close, adj_volume AS volume, prev_adj_close AS prev_close,
       {rounded('CASE WHEN prev_adj_close > 0 THEN (adj_close - prev_adj_close) / prev_adj_close * 100 END', 6)} AS price_change_pct FROM fact WHERE symbol = 'S6' AND date >= DATE '1999-01-01'"""))  # fmt: skip
def daily_series(spark, sf_dir):
    return analytics.daily_series(fact(spark, sf_dir), "S6", dt.date(1999, 1, 1)).withColumn("price_change_pct", exact("price_change_pct", 6))


@named(query(BARS_L, SPLITS, ADJ_MINUTES, select="SELECT start_timestamp, adj_open AS open, adj_high AS high, adj_low AS low, adj_close AS close, adj_volume AS volume FROM minutes WHERE symbol = 'S6' AND date = (SELECT max(date) FROM minutes WHERE symbol = 'S6')"))
def intraday_bars(spark, sf_dir):
    return analytics.intraday(minutes(spark, sf_dir), "S6")


@named(query(*FACTS, select="SELECT date, adj_close FROM fact WHERE symbol = 'S6' AND date < DATE '2000-01-01' ORDER BY date DESC LIMIT 1"))
def previous_session(spark, sf_dir):
    return analytics.previous_close(fact(spark, sf_dir), "S6", dt.date(2000, 1, 1))


@named(query(BARS_L, DAILY, select="SELECT symbol, min(date) AS min_date, max(date) AS max_date FROM daily GROUP BY 1"))
def date_ranges(spark, sf_dir):
    return analytics.date_ranges(daily(spark, sf_dir))


@named(query(NEWS, select="SELECT published_date, title, 'Wire' AS publisher_name, article_url FROM fact_news WHERE symbol = 'S3' AND published_date >= DATE '2001-10-05' ORDER BY published_date DESC, article_id LIMIT 50"))
def recent_news(spark, sf_dir):
    return analytics.recent_news(news_fact(spark, sf_dir), "S3", dt.date(2001, 10, 5))


@named(query(TICKERS, select="SELECT symbol, company_name FROM tickers"))
def ticker_picker(spark, sf_dir):
    return analytics.ticker_picker(tickers(spark, sf_dir))


@named(query(BARS_L, DAILY, select="""
SELECT (SELECT max(date) FROM daily) AS max_date, (SELECT max(start_timestamp) FROM bars) AS max_start_timestamp,
       strftime(timezone('America/New_York', timezone('UTC', make_timestamp((SELECT max(start_timestamp) FROM bars) * 1000))), '%Y-%m-%d %H:%M ET') AS minute_label"""))  # fmt: skip
def freshness(spark, sf_dir):
    return analytics.freshness(daily(spark, sf_dir), td.minute_bars(spark, sf_dir))


# ---- data quality


def _orphans(name: str, source: str) -> str:
    return f"SELECT '{name}' AS fact_table, count(*) AS total_rows, count_if(d.symbol IS NULL) AS orphan_rows, count(DISTINCT f.symbol) AS total_symbols, count(DISTINCT CASE WHEN d.symbol IS NULL THEN f.symbol END) AS orphan_symbols FROM {source} f LEFT JOIN known d ON f.symbol = d.symbol"


@named(query(BARS_L, DAILY, TICKERS, NEWS, "\nknown AS (SELECT symbol FROM tickers WHERE is_active)", select=f"""
, o AS ({_orphans('daily', 'daily')} UNION ALL {_orphans('minute', 'bars')} UNION ALL {_orphans('news', '(SELECT * FROM fact_news WHERE symbol IS NOT NULL)')})
SELECT fact_table, total_rows, orphan_rows, {rounded('100.0 * orphan_rows / NULLIF(total_rows, 0)', 3)} AS orphan_row_pct, total_symbols, orphan_symbols, {rounded('100.0 * orphan_symbols / NULLIF(total_symbols, 0)', 3)} AS orphan_symbol_pct FROM o"""))  # fmt: skip
def orphan_summary(spark, sf_dir):
    known = tickers(spark, sf_dir).where("is_active")
    return facts.orphan_summary({"daily": daily(spark, sf_dir), "minute": td.minute_bars(spark, sf_dir), "news": news_fact(spark, sf_dir)}, known)


@named(query(BARS_L, DAILY, TICKERS, select="""
SELECT symbol, count(*) AS fact_rows, min(date) AS first_seen, max(date) AS last_seen FROM daily WHERE symbol NOT IN (SELECT symbol FROM tickers WHERE is_active)
GROUP BY 1 ORDER BY fact_rows DESC, symbol LIMIT 100"""))  # fmt: skip
def orphan_symbols(spark, sf_dir):
    return facts.orphan_symbols(daily(spark, sf_dir), tickers(spark, sf_dir).where("is_active"))


@named(query(*FACTS, select=f"""
SELECT symbol, date, prev_adj_close, adj_close, {pct('adj_close', 'prev_adj_close')} AS change_pct FROM fact WHERE prev_adj_close > 0 AND abs(adj_close / prev_adj_close - 1) >= 0.40"""))  # fmt: skip
def unexplained_gaps(spark, sf_dir):
    return analytics.unexplained_gaps(fact(spark, sf_dir))


@named("SELECT 'bars' AS dataset, 'rule_' || event_type AS name, CAST(sum(event_id) AS BIGINT) AS passed_records, CAST(sum(json_extract(props, '$.k')::BIGINT) AS BIGINT) AS failed_records FROM events GROUP BY 1, 2")
def expectation_event_log(spark, sf_dir):
    e = td.table(spark, sf_dir, "events")
    one = F.struct(F.concat(F.lit("rule_"), "event_type").alias("name"), F.lit("bars").alias("dataset"), F.col("event_id").alias("passed_records"), F.get_json_object("props", "$.k").cast("long").alias("failed_records"))
    details = F.to_json(F.struct(F.struct(F.struct(F.array(one).alias("expectations")).alias("data_quality")).alias("flow_progress")))
    return rules.event_log(e.select(details.alias("details")))


@named(query(BARS_L, DAILY, select="SELECT date, count(*) AS rows FROM daily GROUP BY 1"))
def partition_counts(spark, sf_dir):
    return analytics.partition_counts(daily(spark, sf_dir), "date")


@named(query(BARS_L, DAILY, select="""
SELECT 'run' || CAST(year(date) AS VARCHAR) AS correlation_id, count(*) AS rows, count(DISTINCT symbol) AS symbols, min(date) AS min_date, max(date) AS max_date, CAST(min(date) AS TIMESTAMP) AS started
FROM daily GROUP BY 1 ORDER BY started DESC LIMIT 5"""))  # fmt: skip
def run_health(spark, sf_dir):
    rows = daily(spark, sf_dir).withColumn("correlation_id", F.concat(F.lit("run"), F.year("date"))).withColumn("processing_timestamp", F.col("date").cast("timestamp_ntz"))
    return analytics.run_health(rows)


# ---- indicators


@named(query(BARS_L, DAILY, select=f"""
SELECT symbol, date, {rounded('avg(close) OVER w', 6)} AS sma_20, {rounded('sum((high + low + close) / 3 * volume) OVER w / NULLIF(sum(volume) OVER w, 0)', 6)} AS vwap
FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""))  # fmt: skip
def chart_overlays(spark, sf_dir):
    return indicators.overlays(daily(spark, sf_dir)).select("symbol", "date", exact("sma_20", 6), exact("vwap", 6))


@named(query(BARS_L, select=f"""
SELECT symbol, start_timestamp, {rounded('sum((high + low + close) / 3 * volume) OVER w / NULLIF(sum(volume) OVER w, 0)', 6)} AS vwap
FROM bars WINDOW w AS (PARTITION BY symbol, date ORDER BY start_timestamp ROWS UNBOUNDED PRECEDING)"""))  # fmt: skip
def session_vwap(spark, sf_dir):
    return indicators.session_vwap(td.minute_bars(spark, sf_dir)).select("symbol", "start_timestamp", exact("vwap", 6))


_TRAIL = ("avg_vol_20d", "high_52w", "low_52w", "pct_from_52w_high", "realized_vol_20d", "max_drawdown_63d", "vol_ratio", "pct_from_sma_20")


@named(query(BARS_L, DAILY, select=f"""
, r AS (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS ret, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS age FROM daily),
k AS (SELECT symbol, date, close / max(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS fall FROM r WHERE age <= 63),
d AS (SELECT symbol, CASE WHEN count(*) = 63 THEN min(fall) * 100 END AS max_drawdown_63d FROM k GROUP BY 1),
a AS (
  SELECT symbol, arg_max(close, date) AS close, arg_max(volume, date) AS volume,
         CASE WHEN count(volume) FILTER (WHERE age BETWEEN 2 AND 21) = 20 THEN avg(volume) FILTER (WHERE age BETWEEN 2 AND 21) END AS avg_vol_20d,
         CASE WHEN count(*) FILTER (WHERE age <= 252) = 252 THEN max(high) FILTER (WHERE age <= 252) END AS high_52w,
         CASE WHEN count(*) FILTER (WHERE age <= 252) = 252 THEN min(low) FILTER (WHERE age <= 252) END AS low_52w,
         CASE WHEN count(ret) FILTER (WHERE age <= 20) = 20 THEN stddev_samp(ret) FILTER (WHERE age <= 20) * sqrt(252.0) * 100 END AS realized_vol_20d,
         avg(close) FILTER (WHERE age <= 20) AS sma
  FROM r GROUP BY 1)
SELECT symbol, {rounded('avg_vol_20d', 4)} AS avg_vol_20d, {rounded('high_52w', 4)} AS high_52w, {rounded('low_52w', 4)} AS low_52w, {rounded('(close - high_52w) / high_52w * 100', 4)} AS pct_from_52w_high,
       {rounded('realized_vol_20d', 4)} AS realized_vol_20d, {rounded('max_drawdown_63d', 4)} AS max_drawdown_63d, {rounded('volume / avg_vol_20d', 4)} AS vol_ratio, {rounded('(close - sma) / sma * 100', 4)} AS pct_from_sma_20
FROM a JOIN d USING (symbol)"""))  # fmt: skip
def trailing_stats(spark, sf_dir):
    return indicators.trailing_stats(daily(spark, sf_dir)).select("symbol", *[exact(c, 4) for c in _TRAIL])


@named(query(BARS_L, DAILY, select=f"""
SELECT symbol, max(high) AS period_high, min(low) AS period_low, arg_min(close, date) AS first_close, arg_max(close, date) AS last_close, {rounded('avg(volume)', 4)} AS avg_volume,
       {rounded('(arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100', 4)} AS period_return_pct FROM daily GROUP BY 1"""))  # fmt: skip
def period_summary(spark, sf_dir):
    return indicators.period_summary(daily(spark, sf_dir)).withColumns({"avg_volume": exact("avg_volume", 4), "period_return_pct": exact("period_return_pct", 4)})


@named(query(BARS_L, DAILY, select=f"""
, p AS (SELECT * FROM daily WHERE volume > 0),
m AS (SELECT symbol, min(low) AS lo, max(high) AS hi, quantile_cont(high - low, 0.5) AS typical FROM p GROUP BY 1),
s AS (SELECT symbol, lo, hi, greatest(20, least(100, CAST(round_even((hi - lo) / (CASE WHEN typical > 0 THEN typical ELSE (hi - lo) / 50 END / 2), 0) AS INTEGER))) AS n_bins FROM m WHERE hi > lo),
z AS (SELECT *, (hi - lo) / n_bins AS bin_size FROM s),
b AS (SELECT p.symbol, volume, greatest(0, least(n_bins - 1, CAST(floor((low - lo) / bin_size) AS INTEGER))) AS a, greatest(0, least(n_bins - 1, CAST(floor((high - lo) / bin_size) AS INTEGER))) AS c FROM p JOIN z USING (symbol)),
x AS (SELECT symbol, CAST(unnest(generate_series(a, c)) AS INTEGER) AS bin, volume / (c - a + 1) AS v FROM b),
y AS (SELECT symbol, n_bins, lo AS price_low, bin_size, CAST(unnest(generate_series(0, n_bins - 1)) AS INTEGER) AS bin FROM z)
SELECT symbol, bin, n_bins, {rounded('price_low', 4)} AS price_low, {rounded('bin_size', 6)} AS bin_size, {rounded('coalesce(sum(v), 0)', 3)} AS volume FROM y LEFT JOIN x USING (symbol, bin) GROUP BY 1, 2, 3, price_low, bin_size"""))  # fmt: skip
def volume_bins(spark, sf_dir):
    rows = indicators.volume_bins(daily(spark, sf_dir))
    return rows.select("symbol", "bin", "n_bins", exact("price_low", 4), exact("bin_size", 6), exact("volume", 3))


@named(query(BARS_L, DAILY, select="""
, ranges AS (
  SELECT symbol, min(low) AS price_low, max(high) - min(low) AS span, list_sort(list(high - low)) AS r
  FROM daily WHERE volume > 0 GROUP BY symbol),
typical AS (SELECT *, (r[(len(r) + 1) // 2] + r[len(r) // 2 + 1]) / 2 AS typical FROM ranges WHERE span > 0),
binned AS (
  SELECT symbol, price_low, span, CAST(greatest(20, least(100, round_even(span / (CASE WHEN typical > 0 THEN typical ELSE span / 50 END / 2), 0))) AS INTEGER) AS n_bins
  FROM typical),
shape AS (SELECT *, span / n_bins AS bin_size FROM binned),
placed AS (
  SELECT symbol, volume, greatest(0, least(n_bins - 1, CAST(floor((low - price_low) / bin_size) AS INTEGER))) AS lo,
         greatest(0, least(n_bins - 1, CAST(floor((high - price_low) / bin_size) AS INTEGER))) AS hi
  FROM daily JOIN shape USING (symbol) WHERE volume > 0),
spread AS (SELECT symbol, unnest(generate_series(lo, hi)) AS bin, CAST(CAST(volume AS DOUBLE) / (hi - lo + 1) AS DECIMAL(28, 6)) AS volume FROM placed),
summed AS (SELECT symbol, bin, CAST(sum(volume) AS DOUBLE) AS volume FROM spread GROUP BY symbol, bin),
every AS (SELECT symbol, unnest(generate_series(0, n_bins - 1)) AS bin FROM shape),
listed AS (SELECT symbol, list(coalesce(volume, 0) ORDER BY bin) AS v FROM every LEFT JOIN summed USING (symbol, bin) GROUP BY symbol),
profile AS (
  SELECT *, list_reduce(list_prepend(0::DOUBLE, v), lambda a, x: a + x) AS total_volume, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS poc
  FROM listed JOIN shape USING (symbol)),
area AS (
  SELECT symbol, 0 AS step, poc AS lo, poc AS hi, v[poc + 1] AS held FROM profile WHERE total_volume > 0
  UNION ALL
  SELECT symbol, step + 1, CASE WHEN up THEN lo ELSE greatest(lo - 2, 0) END, CASE WHEN up THEN least(hi + 2, n_bins - 1) ELSE hi END, held + CASE WHEN up THEN above ELSE below END
  FROM (SELECT *, (above >= below AND hi < n_bins - 1) OR lo = 0 AS up
        FROM (SELECT symbol, step, lo, hi, held, n_bins, coalesce(v[hi + 2], 0) + coalesce(v[hi + 3], 0) AS above,
                     CASE WHEN lo >= 1 THEN v[lo] ELSE 0 END + CASE WHEN lo >= 2 THEN v[lo - 1] ELSE 0 END AS below
              FROM area JOIN profile USING (symbol) WHERE held < total_volume * 0.7::DOUBLE AND NOT (lo = 0 AND hi = n_bins - 1)))),
grown AS (SELECT symbol, arg_max(lo, step) AS lo, arg_max(hi, step) AS hi, arg_max(held, step) AS held FROM area GROUP BY symbol)
SELECT symbol, n_bins, price_low + (poc + 0.5::DOUBLE) * bin_size AS poc_price, price_low + lo * bin_size AS value_area_low,
       price_low + (hi + 1) * bin_size AS value_area_high, held AS value_area_volume, total_volume
FROM profile JOIN grown USING (symbol)""").replace("WITH", "WITH RECURSIVE", 1))  # fmt: skip
def volume_profile(spark, sf_dir):
    return indicators.volume_profile(daily(spark, sf_dir))


@named(query(BARS_L, DAILY, select="""
SELECT symbol, date, CASE WHEN volume >= 1000 THEN '$' || CAST(floor(volume / 1000.0 + 0.5) AS BIGINT) || 'K' ELSE '$' || volume END AS label FROM daily"""))  # fmt: skip
def compact_labels(spark, sf_dir):
    return daily(spark, sf_dir).select("symbol", "date", classify.compact_number(F.col("volume"), "$").alias("label"))


# ---- the query layer as SQL text


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """The star schema as temporary views, for spark.sql with named parameters."""
    fact(spark, sf_dir).createOrReplaceTempView("fact_daily_market_adjusted")
    tickers(spark, sf_dir).createOrReplaceTempView("dim_ticker")


@named(query(*FACTS, TICKERS, select="SELECT f.symbol, t.sector, f.date, f.adj_close FROM fact f JOIN tickers t ON f.symbol = t.symbol WHERE f.symbol IN ('S1', 'S3') AND f.date >= DATE '2001-01-01'"))
def sql_parameters(spark, sf_dir):
    register_views(spark, sf_dir)
    text = "SELECT f.symbol, t.sector, f.date, f.adj_close FROM fact_daily_market_adjusted f JOIN dim_ticker t ON f.symbol = t.symbol WHERE array_contains(:symbols, f.symbol) AND f.date >= :since"
    return spark.sql(text, args={"symbols": F.array(F.lit("S1"), F.lit("S3")), "since": dt.date(2001, 1, 1)})


# ---- tables, files and streams: written to a scratch folder and read back


def by_year(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", "date", "start_timestamp", "close", "l_returnflag", F.year("date").alias("year"))


def year_table(spark: SparkSession, name: str) -> storage.ParquetTable:
    return storage.ParquetTable(spark, scratch_folder(spark, name), partition=("year",), sort=("symbol",))


@named(query(BARS_L, select="SELECT symbol, date, start_timestamp, close, CAST(year(date) AS INTEGER) AS year FROM bars WHERE l_returnflag IN ('A', 'R') OR year(date) = 1996"))
def table_modes(spark, sf_dir):
    """Create, append, and an overwrite of one partition with all its rows, twice."""
    bars, table = by_year(td.minute_bars(spark, sf_dir)), year_table(spark, "modes")
    table.create(bars.where("l_returnflag = 'A'").drop("l_returnflag"))
    table.append(bars.where("l_returnflag = 'R'").drop("l_returnflag"))
    for _ in range(2):
        table.overwrite_partitions(bars.where("year = 1996").drop("l_returnflag"))
    return table.read()


@named(query(BARS_L, select="""
SELECT 'create' AS operation, count(*) AS rows, CAST(min(year(date)) AS VARCHAR) AS first, CAST(max(year(date)) AS VARCHAR) AS last FROM bars WHERE l_returnflag = 'A'
UNION ALL SELECT 'append', count(*), CAST(min(year(date)) AS VARCHAR), CAST(max(year(date)) AS VARCHAR) FROM bars WHERE l_returnflag = 'R'
UNION ALL SELECT 'replace', count(*), CAST(min(year(date)) AS VARCHAR), CAST(max(year(date)) AS VARCHAR) FROM bars"""))  # fmt: skip
def table_history(spark, sf_dir):
    bars, table = by_year(td.minute_bars(spark, sf_dir)), year_table(spark, "history")
    table.create(bars.where("l_returnflag = 'A'"))
    table.append(bars.where("l_returnflag = 'R'"))
    table.replace(bars)
    return table.history().drop("at")


@named(query(BARS_L, select="SELECT symbol, start_timestamp, close FROM bars"))
def inserted_rows(spark, sf_dir):
    """An insert-only merge into a table that has a part of the keys, and the same merge again."""
    bars, table = by_year(td.minute_bars(spark, sf_dir)), year_table(spark, "inserted")
    table.create(bars.where("l_returnflag = 'A'"))
    for _ in range(2):
        table.insert_new(bars)
    return table.read().select("symbol", "start_timestamp", "close")


@named(query(TICKERS, select="""
SELECT symbol, 'old' AS name, DATE '2001-11-01' AS snapshot_date FROM details WHERE symbol <> 'S1'
UNION ALL SELECT symbol, name, DATE '2001-11-04' FROM details WHERE active"""))  # fmt: skip
def replaced_snapshot(spark, sf_dir):
    """The later of two snapshots is replaced by one with active symbols only."""
    details = td.ticker_details(spark, sf_dir)
    table = storage.ParquetTable(spark, scratch_folder(spark, "snapshots"), partition=("snapshot_date",))
    table.append(details)
    table.replace_snapshot(details.where(F.col("active") & (F.col("snapshot_date") == F.lit(AS_OF))), AS_OF)
    return table.read().select("symbol", "name", "snapshot_date")


@named(query(BARS_L, select="SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS rows FROM bars GROUP BY 1"))
def previewed_append(spark, sf_dir):
    """What a dry run says of an append, by partition."""
    return storage.preview(by_year(td.minute_bars(spark, sf_dir)), ("year",))


@named(query(BARS_L, select="SELECT symbol, date, start_timestamp, open, high, low, close, volume FROM bars"))
def flat_file_scan(spark, sf_dir):
    """Bars as gzipped CSV files, read in one scan with the declared schema and mapped."""
    b, folder = td.minute_bars(spark, sf_dir), scratch_folder(spark, "flatfiles")
    raw = b.select(F.col("symbol").alias("ticker"), F.col("volume").cast("double").alias("volume"), "open", "close", "high", "low", (F.col("start_timestamp") * 1_000_000).alias("window_start"), F.lit(1).alias("transactions"))
    raw.write.option("header", True).option("compression", "gzip").csv(folder)
    rows = flatfiles.historical_bars(flatfiles.read_flat_files(spark, [p for p, _ in flatfiles.existing(spark, [f"{folder}/*.csv.gz"])]), "run")
    return rows.select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume")


@named(query(BARS_L, DAYS, select="""
SELECT 's3a://files/minute/' || strftime(date, '%Y/%m/%Y-%m-%d') || '.csv.gz' AS path, coalesce(bars, 0) AS bars
FROM series LEFT JOIN counted USING (date) WHERE dayofweek(date) BETWEEN 1 AND 5"""))  # fmt: skip
def flat_file_days(spark, sf_dir):
    """The file of each business day that bars come from, and how many bars it would hold."""
    days, first, last = traded_span(spark, sf_dir)
    paths = spark.createDataFrame([(p, p[-17:-7]) for p in flatfiles.flat_file_paths(str(first), str(last), "files", "files/minute")], "path string, day string")
    return paths.join(days, F.to_date("day") == F.col("date"), "left").select("path", F.coalesce("bars", F.lit(0)).alias("bars"))


@named("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def path_scan(spark, sf_dir):
    return storage.path_table(spark, f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")


@named(query(*FACTS, TICKERS, GRID, select="SELECT symbol, close, volume FROM grid"))
def csv_export(spark, sf_dir):
    folder = scratch_folder(spark, "export")
    storage.export_csv(grid(spark, sf_dir).select("symbol", "close", "volume"), folder)
    return spark.read.schema("symbol string, close double, volume long").option("header", True).csv(folder)


@named("""
SELECT CAST(event_id AS BIGINT) AS "offset", CASE WHEN event_id % 10 = 0 THEN NULL ELSE upper(event_type) END AS symbol, CASE WHEN event_id % 10 = 0 THEN 'undecodable' END AS quarantine_reason FROM events""")  # fmt: skip
def streamed_messages(spark, sf_dir):
    """Messages from a stream of files: good rows and dead letters go to a table each, by queries of their own."""
    e = td.table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    root = scratch_folder(spark, "messages")
    e.repartition(3).write.parquet(f"{root}/arrived")
    e = storage.stream_table(spark, f"{root}/arrived", e.schema, files_per_batch=2)
    body = F.to_json(F.struct(F.upper("event_type").alias("symbol"), F.col("value").alias("close"), F.lit(1).alias("volume"), F.unix_millis("ts").alias("start_timestamp")))
    body = F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(body)
    sent = e.select(F.lit("k").alias("key"), F.concat(F.lit(bytes(5)), body.cast("binary")).alias("value"), F.lit("bars").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    good, dead = messages.split_messages(sent, "run")
    folders = lifecycle.make_folders(root, ("streaming", "streaming_quarantine"))
    for q in lifecycle.start_writers(good.select("symbol", "offset", "date"), dead.select("offset", "quarantine_reason"), folders, (None, None)):
        q.awaitTermination()
        lifecycle.check_alive([q])
    kept = spark.read.parquet(folders["streaming"][0]).select("offset", "symbol", F.lit(None).cast("string").alias("quarantine_reason"))
    return kept.unionByName(spark.read.parquet(folders["streaming_quarantine"][0]).select("offset", F.lit(None).cast("string").alias("symbol"), "quarantine_reason"))


# ---- smaller transforms


@named(query(BARS_L, select="SELECT symbol, start_timestamp FROM bars WHERE l_linenumber <> 1"))
def exchange_traded(spark, sf_dir):
    """Some bars are over the counter, some say that they are not, others do not say."""
    b = td.minute_bars(spark, sf_dir)
    told = b.withColumn("otc", F.when(F.col("l_linenumber") == 1, True).when(F.col("l_linenumber") == 2, False))
    return silver.exchange_traded(told).select("symbol", "start_timestamp")


@named(query(BARS_L, DAILY, select="SELECT symbol, date, open, high, low, close, volume, 'run' AS correlation_id FROM daily WHERE date >= DATE '2001-06-01' - 400"))
def daily_fact_window(spark, sf_dir):
    return facts.with_lineage(facts.daily_fact(daily(spark, sf_dir), dt.date(2001, 6, 1)), "run").drop("processing_timestamp")


@named(query(BARS_L, DIRTY, select="""
, c AS (SELECT date, count(*) AS n, count(*) FILTER (WHERE NOT (ok_price AND ok_logic AND ok_volume)) AS bad FROM judged GROUP BY 1),
s AS (SELECT date, max(n) AS longest FROM (SELECT date, symbol, count(*) AS n FROM judged GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT bad * 100.0::DOUBLE / n < 1.0 OR date < DATE '2000-01-01' - 2 AS passed, longest >= 195 OR date < DATE '2000-01-01' - 2 AS whole FROM c JOIN s USING (date))
SELECT 'quality_gate' AS name, 'fail' AS kind, count_if(passed) AS passed_records, count_if(NOT passed) AS failed_records FROM g
UNION ALL SELECT 'session_complete', 'warn', count_if(whole), count_if(NOT whole) FROM g"""))  # fmt: skip
def audit_gate(spark, sf_dir):
    return rules.violations(audit.audit_log(td.dirty_bars(spark, sf_dir)), *rules.audit_expectations(dt.date(2000, 1, 1)))


@named(query(NEWS, select="""
, o AS (SELECT article_id, trim(regexp_replace(coalesce(description, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') AS line, title, article_url FROM articles),
h AS (SELECT *, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS safe_title,
      replace(replace(replace(replace(replace(article_url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS link FROM o)
SELECT article_id, safe_title AS title, CASE WHEN length(line) > 120 THEN rtrim(substr(line, 1, 119), ' ') || '…' ELSE line END AS summary,
       CASE WHEN regexp_matches(article_url, '^https?://[^ ]+$') THEN link END AS link FROM h"""))  # fmt: skip
def article_cards(spark, sf_dir):
    """News as it is shown: one line of the description, safe inside HTML."""
    return td.news(spark, sf_dir).select("article_id", text.html_escaped(F.col("title")).alias("title"), text.one_line(F.col("description"), 120).alias("summary"), text.safe_url(F.col("article_url")).alias("link"))


@named("""
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN strftime(timezone('America/New_York', timezone('UTC', date_trunc('second', CAST(ts AS TIMESTAMP)))), '%Y-%m-%d %H:%M:%S') END AS market_time FROM events""")  # fmt: skip
def mixed_times(spark, sf_dir):
    """Times as epoch milliseconds, as text, or as neither."""
    e = td.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    mixed = F.when(F.col("event_id") % 3 == 0, F.unix_millis("ts").cast("string")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("soon"))
    return e.select("event_id", F.date_format(timeunits.normalised_market_time(mixed), "yyyy-MM-dd HH:mm:ss").alias("market_time"))


@named(query(BARS_L, select="""
SELECT symbol, start_timestamp FROM bars
WHERE start_timestamp >= epoch_ms(timezone('America/New_York', TIMESTAMP '1999-06-01 10:00:00')) AND start_timestamp < epoch_ms(timezone('America/New_York', TIMESTAMP '1999-06-01 10:32:00'))"""))  # fmt: skip
def backfill_window(spark, sf_dir):
    """Bars of a window in exchange time, in summer, from 10:00 to 10:32."""
    start, end = timeunits.epoch_window("1999-06-01", "10:00", "10:32")
    return td.minute_bars(spark, sf_dir).where((F.col("start_timestamp") >= start) & (F.col("start_timestamp") < end)).select("symbol", "start_timestamp")


@named(query(BARS_L, select="""
, t AS (SELECT max(date) AS d, CAST(date_trunc('quarter', max(date)) AS DATE) AS q FROM bars),
v AS (SELECT 'ytd' AS name, CAST(date_trunc('year', d) AS DATE) AS first, d AS last FROM t UNION ALL SELECT 'mtd', CAST(date_trunc('month', d) AS DATE), d FROM t UNION ALL SELECT 'this quarter', q, d FROM t
      UNION ALL SELECT 'last quarter', CAST(q - INTERVAL 3 MONTH AS DATE), q - 1 FROM t UNION ALL SELECT '30 days', d - 30, d FROM t)
SELECT name, first, last, count(bars.date) AS bars FROM v LEFT JOIN bars ON date BETWEEN first AND last GROUP BY ALL"""))  # fmt: skip
def range_presets(spark, sf_dir):
    """Named ranges up to the last bar, and the bars in each."""
    days, _, today = traded_span(spark, sf_dir)
    names = ("ytd", "mtd", "this quarter", "last quarter", "30 days")
    ranges = spark.createDataFrame([(n, *timeunits.relative_range(n, today)) for n in names], "name string, first date, last date")
    inside = days.join(F.broadcast(ranges), F.col("date").between(F.col("first"), F.col("last"))).groupBy("name").agg(F.sum("bars").alias("bars"))
    return ranges.join(inside, "name", "left").withColumn("bars", F.coalesce("bars", F.lit(0)))


@named(query(BARS_L, select="SELECT symbol, date, count(*) AS rows FROM bars GROUP BY 1, 2 HAVING count(*) > 1"))
def repeated_keys(spark, sf_dir):
    """A key check that fails: minutes share their symbol and date."""
    return dims.duplicate_keys(td.minute_bars(spark, sf_dir), "symbol", "date")


@named(query(BARS_L, TICKERS, select="SELECT DISTINCT symbol FROM bars WHERE symbol NOT IN (SELECT symbol FROM tickers WHERE is_active)"))
def missing_tickers(spark, sf_dir):
    """A foreign key check that fails: bars of symbols that are not active."""
    return dims.missing_parents(td.minute_bars(spark, sf_dir), tickers(spark, sf_dir).where("is_active"), "symbol")


# ---- as-of joins in bulk, incremental refresh, sketches, Bloom filters, pages


@named(query(BARS_L, SPLITS, ADJ_MINUTES, select="SELECT * FROM minutes"))
def adjusted_minutes_as_of(spark, sf_dir):
    """Minutes meet their splits in an as-of join: nothing is broadcast."""
    bars = td.minute_bars(spark, sf_dir).select("symbol", "date", "start_timestamp", "open", "high", "low", "close", "volume")
    return splits.adjusted(bars, splits.split_dimension(td.splits(spark, sf_dir)), broadcast_bytes=-1)


@named(query(*FACTS, NEWS, select="""
SELECT article_id, n.symbol, published_date, f.adj_close AS previous_close, f.date AS previous_date
FROM (SELECT * FROM fact_news WHERE symbol IS NOT NULL) n ASOF LEFT JOIN fact f ON n.symbol = f.symbol AND n.published_date > f.date"""))  # fmt: skip
def news_previous_close(spark, sf_dir):
    """The last session before each article, for all symbols at once."""
    news = news_fact(spark, sf_dir).select("article_id", "symbol", "published_date")
    sessions = fact(spark, sf_dir).select("symbol", "date", F.col("date").alias("previous_date"), F.col("adj_close").alias("previous_close"))
    return asof.as_of(news, sessions, ["symbol"], "published_date", "date", ["previous_date", "previous_close"])


@named(query(*FACTS, select=f"SELECT * EXCLUDE (rvol_20d), {rounded('rvol_20d', 6)} AS rvol_20d, CAST(year(date) AS INTEGER) AS year FROM fact"))
def refreshed_facts(spark, sf_dir):
    """A table of facts takes over bars that came late and splits that became known: only rows that they reach are
    derived, and only years with such rows are written."""
    bars, known = td.minute_bars(spark, sf_dir), splits.split_dimension(td.splits(spark, sf_dir))
    late = F.col("date").between("2001-03-05", "2001-03-09") & (F.col("l_returnflag") == "N")
    unknown = F.col("symbol").endswith("8")
    table = storage.ParquetTable(spark, scratch_folder(spark, "facts"), partition=("year",), sort=("symbol", "date"))
    incremental.create(table, bars.where(~late), known.where(~unknown))
    incremental.refresh(table, rollup.daily_bars(bars), known, bars.where(late).select("symbol", "date"), known.where(unknown))
    return table.read().withColumn("rvol_20d", exact("rvol_20d", 6))


@named(query(BARS_L, select="SELECT CAST(year(date) AS INTEGER) AS year, count(DISTINCT l_orderkey) AS orders, count(*) AS rows, true AS within FROM bars GROUP BY 1"))
def distinct_orders_by_year(spark, sf_dir):
    """Distinct counts of years from sketches of days, held against exact counts."""
    bars = td.minute_bars(spark, sf_dir)
    days = sketches.daily_sketches(bars, "l_orderkey")
    told = days.groupBy(F.year("date").alias("year")).agg(sketches.distinct_count().alias("estimate"), F.sum("rows").alias("rows"))
    counted = bars.groupBy(F.year("date").alias("year")).agg(F.count_distinct("l_orderkey").alias("orders"))
    near = F.abs(F.col("estimate") - F.col("orders")) <= F.greatest(F.lit(1.0), F.col("orders") * sketches.relative_error())
    return told.join(counted, "year").select("year", "orders", "rows", near.alias("within"))


@named(query(BARS_L, select=f"""
SELECT CAST(year(date) AS INTEGER) AS year, share, {rounded('quantile_cont(close * volume, share)', 4)} AS dollars
FROM bars CROSS JOIN (SELECT unnest([0.5::DOUBLE, 0.7::DOUBLE, 0.9::DOUBLE]) AS share) GROUP BY 1, 2""".replace("quantile_cont(close * volume, share)", "CASE share WHEN 0.5 THEN quantile_cont(close * volume, 0.5) WHEN 0.7 THEN quantile_cont(close * volume, 0.7) ELSE quantile_cont(close * volume, 0.9) END")))  # fmt: skip
def dollar_percentiles(spark, sf_dir):
    """Exact percentiles of all bars of a year: a sketch gives bounds, and only values between them are looked at."""
    bars = td.minute_bars(spark, sf_dir).select(F.year("date").alias("year"), (F.col("close") * F.col("volume")).alias("dollars"))
    found = sketches.exact_percentiles(bars, "dollars", [0.5, 0.7, 0.9], ("year",))
    return found.select("year", "share", F.col("value").alias("dollars")).withColumn("dollars", exact("dollars", 4))


@named(query(BARS_L, select="SELECT symbol, start_timestamp, close FROM bars WHERE l_returnflag <> 'A'"))
def insert_only_filtered(spark, sf_dir):
    """The rows of an insert-only merge, with a Bloom filter ahead of the anti join."""
    batch = td.minute_bars(spark, sf_dir)
    return bloom.anti_join(batch, batch.where("l_returnflag = 'A'"), ["symbol", "start_timestamp"]).select("symbol", "start_timestamp", "close")


@named(query(BARS_L, TICKERS, select="SELECT symbol, count(*) AS bars FROM bars WHERE symbol IN (SELECT symbol FROM tickers WHERE sector = 'Manufacturing') GROUP BY 1"))
def sector_bars(spark, sf_dir):
    """Bars of a sector's symbols: a semi join behind a Bloom filter."""
    wanted = tickers(spark, sf_dir).where("sector = 'Manufacturing'")
    return bloom.semi_join(td.minute_bars(spark, sf_dir), wanted, ["symbol"]).groupBy("symbol").agg(F.count("*").alias("bars"))


@named(query(*FACTS, select="SELECT symbol, date, rvol_20d IS NULL AS unknown, adj_volume FROM fact ORDER BY adj_volume DESC NULLS LAST, symbol, date LIMIT 50 OFFSET 1000"))
def indexed_page(spark, sf_dir):
    """A page deep in a ranking of all sessions, from the ranges that it lies in."""
    rows = fact(spark, sf_dir).select("symbol", "date", F.col("rvol_20d").isNull().alias("unknown"), "adj_volume")
    order = [F.desc_nulls_last("adj_volume"), F.asc("symbol"), F.asc("date")]
    return paging.PageIndex.build(rows, order, scratch_folder(spark, "pages"), 16).page(21, 50)


@named(query(*FACTS, select=f"SELECT * EXCLUDE (rvol_20d), {rounded('rvol_20d', 6)} AS rvol_20d FROM fact"))
def bucketed_facts(spark, sf_dir):
    """Adjusted bars and metrics over daily bars in buckets of symbols: neither the window nor the join moves a bar."""
    table = storage.bucketed_table(daily(spark, sf_dir), f"daily_{uuid.uuid4().hex}", scratch_folder(spark, "buckets"), "symbol", 8, ("symbol", "date"))
    return facts.adjusted_daily_fact(table, splits.split_dimension(td.splits(spark, sf_dir))).withColumn("rvol_20d", exact("rvol_20d", 6))


# ---- named tables, incremental loads, cached results, market sessions


@named("SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def named_tables(spark, sf_dir):
    """Tables that are read by their qualified names."""
    name = f"suppliers_{uuid.uuid4().hex}"
    td.table(spark, sf_dir, "supplier").write.option("path", scratch_folder(spark, "suppliers")).saveAsTable(name)
    suppliers = storage.catalog_table(spark, spark.catalog.currentCatalog(), spark.catalog.currentDatabase(), name)
    nations = td.table(spark, sf_dir, "nation").where("n_regionkey = 1")
    return suppliers.join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select("s_suppkey", "s_name", "s_nationkey")


@named(query(BARS_L, select="SELECT symbol, date, start_timestamp, close, CAST(year(date) AS INTEGER) AS year FROM bars WHERE date <= (SELECT max(date) - 3 FROM bars)"))
def incremental_load(spark, sf_dir):
    """Loads that go on from the table's latest date to a lag of three days, the last of them with nothing to take."""
    bars = by_year(td.minute_bars(spark, sf_dir)).select("symbol", "date", "start_timestamp", "close", "year")
    table, (_, first, today) = year_table(spark, "loaded"), traded_span(spark, sf_dir)
    table.create(bars.where(F.col("date") <= F.date_add(F.lit(first), 900)))
    for now in (first + dt.timedelta(days=1500), today, today):
        window = flatfiles.incremental_window(table.latest(), True, now, lag_days=3)
        if not window.up_to_date:
            table.append(bars.where(F.col("date").between(F.lit(window.first), F.lit(window.last))))
    return table.read()


@named(query(*FACTS, TICKERS, GRID, select="SELECT symbol, close, 2 AS asked FROM grid UNION ALL SELECT symbol, close, 3 FROM grid"))
def cached_results(spark, sf_dir):
    """A result that is asked for twice is derived once, and again when the data's version changes."""
    versions = iter([1, 1, 2])
    cache = analytics.VersionedCache(lambda: next(versions))
    asked = [cache.get("screener", lambda: grid(spark, sf_dir).select("symbol", "close")) for _ in range(3)]
    if asked[0] is not asked[1] or asked[1] is asked[2]:
        raise AssertionError("a result was not kept by its version")
    return asked[1].withColumn("asked", F.lit(2)).unionByName(asked[2].withColumn("asked", F.lit(3)))


def _sessions_sql() -> str:
    first, last = dt.date(1990, 1, 1), dt.date(2005, 12, 31)
    trading = ", ".join(f"DATE '{d}'" for d in calendar.trading_days(first, last))
    early = ", ".join(f"DATE '{d}'" for y in range(first.year, last.year + 1) for d in sorted(calendar.early_closes(y)))
    return query(BARS_L, select=f"""
    SELECT symbol, start_timestamp, CASE WHEN date IN ({early}) THEN 1300 WHEN date IN ({trading}) THEN 1600 ELSE 0 END AS close_hhmm FROM bars""")  # fmt: skip


@named(_sessions_sql())
def session_closes(spark, sf_dir):
    """The close of the session that a bar is in; 0 on days without one."""
    _, first, last = traded_span(spark, sf_dir)
    closes = F.broadcast(calendar.sessions(spark, first, last))  # a row a day
    return td.minute_bars(spark, sf_dir).join(closes, "date", "left").select("symbol", "start_timestamp", F.coalesce("close_hhmm", F.lit(0)).alias("close_hhmm"))


# ---- streams with state


@named(query(BARS_L, select="SELECT symbol, start_timestamp, close, CAST(year(date) AS INTEGER) AS year, CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS batch FROM bars WHERE l_returnflag IN ('A', 'R')"))
def appended_rows(spark, sf_dir):
    """What a stream over a table gives that is created, appended to, overwritten in part and compacted: each appended row once."""
    bars, table = by_year(td.minute_bars(spark, sf_dir)), year_table(spark, "streamed")
    root, kept = scratch_folder(spark, "changes"), ("symbol", "date", "start_timestamp", "close", "year")

    def take(number: int) -> None:
        def write(batch: DataFrame, _: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{root}/seen")

        query = table.changes("silver").writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start()
        query.awaitTermination()
        lifecycle.check_alive([query])

    table.create(bars.where("l_returnflag = 'A'").select(*kept))
    take(0)
    table.append(bars.where("l_returnflag = 'R'").select(*kept))
    take(1)
    table.overwrite_partitions(bars.where("year = 1996").select(*kept))
    table.compact()
    take(2)
    return spark.read.parquet(f"{root}/seen").select("symbol", "start_timestamp", "close", "year", "batch")


@named("""
SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (WHERE event_id % 3 <> 0) AS event_type, arg_max(value, (ts, event_id)) FILTER (WHERE event_id % 4 <> 0) AS value,
       max(event_id) FILTER (WHERE (ts, event_id) = newest) AS event_id
FROM (SELECT *, max((ts, event_id)) OVER (PARTITION BY user_id) AS newest FROM events) GROUP BY user_id""")  # fmt: skip
def streamed_upserts(spark, sf_dir):
    """Events in shuffled files, a third of them twice, through a keyed upsert with state: each column's latest value that is not null."""
    e = td.table(spark, sf_dir, "events")
    e = e.select("user_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"), "event_id", F.col("ts").cast("timestamp").alias("ts"))
    root = scratch_folder(spark, "upserts")
    e.unionByName(e.where("event_id % 3 = 1")).repartition(3, F.xxhash64("event_id", F.lit(7))).write.parquet(f"{root}/arrived")
    arrived = storage.stream_table(spark, f"{root}/arrived", e.schema, files_per_batch=1)
    changes = upserts.changed_winners(arrived, ["user_id"], [F.unix_micros("ts"), F.col("event_id")], F.col("ts"), "400 days")
    query = upserts.write_changes(changes, f"{root}/changes", f"{root}/check")
    query.awaitTermination()
    lifecycle.check_alive([query])
    return upserts.current_rows(spark, f"{root}/changes", e.schema, ["user_id"]).select("user_id", "event_type", "value", "event_id")


@named("""
WITH e AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_id % 50 = 7 AS held FROM events),
m AS (SELECT max(ts) FILTER (WHERE NOT held) - INTERVAL 2 DAY AS mark FROM e)
SELECT event_id, CASE WHEN held AND ts <= date_trunc('millisecond', mark) THEN 'late' ELSE 'kept' END AS outcome FROM e, m""")  # fmt: skip
def deduplicated_events(spark, sf_dir):
    """Events by day, each file twice, and some that were held back until the end: of those, what is more than two days old is
    late and kept aside."""
    e = td.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    root, held = scratch_folder(spark, "deduplicated"), F.col("event_id") % 50 == 7
    newest = e.where(~held).orderBy(F.desc("ts"), "event_id").limit(1)
    for part in (e.where(~held), e.where(~held & (F.col("event_id") % 2 == 0)), newest, e.where(held)):
        part.coalesce(1).write.mode("append").parquet(f"{root}/arrived")
    arrived = storage.stream_table(spark, f"{root}/arrived", e.schema, files_per_batch=1)
    query = lateness.deduplicated_stream(arrived, ["event_id"], "ts", dt.timedelta(days=2), f"{root}/out", f"{root}/check")
    query.awaitTermination()
    lifecycle.check_alive([query])
    return spark.read.parquet(f"{root}/out/kept").select("event_id", F.lit("kept").alias("outcome")).unionByName(spark.read.parquet(f"{root}/out/late").select("event_id", F.lit("late").alias("outcome")))
