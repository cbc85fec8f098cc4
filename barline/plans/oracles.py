"""The test tables' projections and the engine's results in DuckDB SQL, for comparison."""

from __future__ import annotations


def rounded(x: str, n: int) -> str:
    """Decimal rounding, half up: doubles alone do not round alike in both engines."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28, 10)), {n}) AS DOUBLE)"


def pct(now: str, before: str, n: int = 2) -> str:
    return rounded(f"(({now} - {before}) / NULLIF({before}, 0) * 100)", n)


BARS_L = """
lines AS (
  SELECT *, CAST(l_shipdate AS DATE) AS day, l_extendedprice * (0.95::DOUBLE + l_discount) AS closed,
         row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS seq
  FROM lineitem),
raw AS (
  SELECT 'S' || l_suppkey AS symbol, day AS date, epoch_ms(CAST(day AS TIMESTAMP)) + 52200000 + (seq - 1) * 60000 AS start_timestamp,
         l_extendedprice AS open, greatest(l_extendedprice, closed) + 100 * l_tax AS high, least(l_extendedprice, closed) - 100 * l_tax AS low,
         closed AS close, CAST(l_quantity AS BIGINT) * 100 AS volume, 'flatfile' AS source, 1000000000 AS ingested,
         l_orderkey, l_linenumber, l_returnflag, l_quantity, l_tax
  FROM lines),
bars AS (SELECT * FROM raw)"""
DIRTY = """
dirty AS (
  SELECT symbol, date, start_timestamp, CASE WHEN l_tax = 0 AND l_linenumber = 1 THEN 0.0 ELSE open END AS open, high,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN high + 1 ELSE low END AS low,
         CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE close END AS close, CASE WHEN l_quantity = 50 THEN -1 ELSE volume END AS volume, source
  FROM raw),
judged AS (
  SELECT *, open > 0 AND high > 0 AND low > 0 AND close > 0 AS ok_price,
         low <= high AND open BETWEEN low AND high AND close BETWEEN low AND high AS ok_logic, volume >= 0 AS ok_volume
  FROM dirty)"""
DAILY = """
daily AS (
  SELECT symbol, date, arg_min(open, start_timestamp) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, start_timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM bars GROUP BY symbol, date)"""
SPLITS = """
splits AS (
  SELECT 'S' || s_suppkey AS symbol, DATE '1997-06-02' + CAST(s_suppkey % 200 AS INTEGER) AS execution_date,
         CASE WHEN s_suppkey % 6 = 0 THEN 0.1::DOUBLE ELSE 0.5::DOUBLE END AS factor, 2.0::DOUBLE AS split_to
  FROM supplier WHERE s_suppkey % 3 = 0
  UNION ALL
  SELECT 'S' || s_suppkey, DATE '1999-06-01' + CAST(s_suppkey % 200 AS INTEGER), 0.2::DOUBLE, 5.0::DOUBLE FROM supplier WHERE s_suppkey % 6 = 0),
segments AS (
  SELECT symbol, lag(execution_date) OVER (PARTITION BY symbol ORDER BY execution_date) AS valid_from, execution_date AS valid_to, factor FROM splits)"""
_PRICES = ", ".join(f"{rounded(f'b.{c} * coalesce(g.factor, 1.0::DOUBLE)', 6)} AS adj_{c}" for c in ("open", "high", "low", "close"))
ADJ_COLUMNS = f"""{_PRICES},
         CAST(ROUND(CAST(b.volume * (1.0::DOUBLE / coalesce(g.factor, 1.0::DOUBLE)) AS DECIMAL(28, 6)), 0) AS BIGINT) AS adj_volume,
         {rounded('coalesce(g.factor, 1.0::DOUBLE)', 8)} AS price_factor"""
_ON = "b.symbol = g.symbol AND b.date < g.valid_to AND (g.valid_from IS NULL OR b.date >= g.valid_from)"
ADJ = f"""
adj AS (SELECT b.*, {ADJ_COLUMNS} FROM daily b LEFT JOIN segments g ON {_ON})"""
ADJ_MINUTES = f"""
minutes AS (SELECT b.symbol, b.date, b.start_timestamp, b.open, b.high, b.low, b.close, b.volume, {ADJ_COLUMNS} FROM bars b LEFT JOIN segments g ON {_ON})"""
_LAGS = ", ".join(f"lag(adj_close, {n}) OVER w AS close_{n}d" for n in (5, 21, 63, 126, 252))
FACT = f"""
fact AS (
  SELECT *, lag(adj_close) OVER w AS prev_adj_close, {_LAGS},
         CASE WHEN count(adj_volume) OVER p = 20 AND avg(adj_volume) OVER p > 0 THEN adj_volume / avg(adj_volume) OVER p END AS rvol_20d
  FROM adj WINDOW w AS (PARTITION BY symbol ORDER BY date), p AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


def _sector_sql() -> str:
    from ..functions.classify import FINANCIAL_TYPES, SECTOR_OF_SIC

    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTOR_OF_SIC.items())
    kinds = ", ".join(f"'{t}'" for t in FINANCIAL_TYPES)
    return f"coalesce(CASE substr(sic_code, 1, 2) {arms} END, CASE WHEN type IN ({kinds}) THEN 'Financial Services' ELSE 'Other' END)"


def _industry_sql() -> str:
    from ..functions.classify import INDUSTRY_OF_TYPE

    return "coalesce(sic_description, CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INDUSTRY_OF_TYPE.items()) + " END)"


TICKERS = f"""
details AS (
  SELECT 'S' || s_suppkey AS symbol, s_name AS name, ['CS', 'ETF', 'ADRC', 'WARRANT'][s_suppkey % 4 + 1] AS type, s_suppkey % 10 <> 0 AS active,
         CASE WHEN s_suppkey % 10 <> 0 THEN r_name END AS primary_exchange,
         CASE WHEN s_suppkey % 7 <> 0 THEN lpad(CAST(10 + 3 * s_nationkey AS VARCHAR), 2, '0') || '00' END AS sic_code,
         CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS sic_description,
         CASE WHEN s_suppkey % 11 <> 0 THEN greatest(s_acctbal, 0.0) * greatest(s_acctbal, 0.0) * greatest(s_acctbal, 0.0) END AS market_cap
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
tickers AS (
  SELECT symbol, name AS company_name, type, {_sector_sql()} AS sector, {_industry_sql()} AS industry, primary_exchange AS exchange,
         CASE WHEN market_cap IS NULL THEN 'Unknown' WHEN market_cap > 200e9 THEN 'Mega Cap' WHEN market_cap > 10e9 THEN 'Large Cap' WHEN market_cap > 2e9 THEN 'Mid Cap'
              WHEN market_cap > 300e6 THEN 'Small Cap' WHEN market_cap > 50e6 THEN 'Micro Cap' ELSE 'Nano Cap' END AS market_cap_category,
         active AS is_active, DATE '1990-01-02' AS list_date
  FROM details)"""
NEWS = """
articles AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS article_id, CASE WHEN d.doc_id % 31 = 0 THEN '  ' WHEN d.doc_id % 5 = 0 THEN '  ' || substr(d.text, 1, 80) || ' ' ELSE substr(d.text, 1, 80) END AS title,
         CASE WHEN d.doc_id % 23 = 0 THEN NULL WHEN d.doc_id % 7 = 0 THEN '   ' || d.text ELSE d.text END AS description,
         d.source AS author, DATE '2001-10-01' + CAST(d.doc_id % 34 AS INTEGER) AS day, d.doc_id % 41 <> 0 AS dated,
         CASE WHEN d.doc_id % 37 = 0 THEN 'ftp:' || p.url ELSE p.url END AS article_url, CASE WHEN d.doc_id % 2 = 0 THEN p.url END AS image_url,
         CASE WHEN d.doc_id % 29 = 0 THEN ['S' || (d.doc_id % n + 1), NULL]
              WHEN d.doc_id % 3 = 0 THEN ['S' || (d.doc_id % n + 1)]
              WHEN d.doc_id % 3 = 1 THEN ['S' || (d.doc_id % n + 1), 'S' || ((d.doc_id + 7) % n + 1)]
              ELSE ['S' || (d.doc_id % n + 1), 'S' || ((d.doc_id + 7) % n + 1), 'S' || (d.doc_id % n + 1)] END AS tickers
  FROM documents d CROSS JOIN (SELECT count(*) AS n FROM supplier) CROSS JOIN (SELECT count(*) AS np FROM pages) LEFT JOIN pages p ON d.doc_id % np = p.page_id),
checked AS (
  SELECT *, length(trim(title, ' ')) > 0 AS ok_title, coalesce(regexp_matches(article_url, '^https?://[^ ]+$'), false) AS ok_url, dated AS ok_time FROM articles),
silver_news AS (SELECT * FROM checked WHERE ok_title AND ok_url AND ok_time),
fact_news AS (
  SELECT DISTINCT article_id, unnest(tickers) AS symbol, day AS published_date, trim(title, ' ') AS title, substr(trim(coalesce(description, ''), ' '), 1, 500) AS description, article_url, author
  FROM silver_news)"""


def query(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


FACTS = (BARS_L, DAILY, SPLITS, ADJ, FACT)
