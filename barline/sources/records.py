"""Rows at the edges: vendor messages and API objects to flat records, and bounded retries."""

from __future__ import annotations

import datetime as dt
import json
import random
import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import NEWS, REST_BARS, SPLITS, TICKER_DETAILS

MINUTE_MS = 60_000
MAX_WORKERS = 32
RETRY_STATUS = frozenset({429, 500, 502, 503, 504})

#: Message field: (key on the wire, type, what a missing value becomes). Optional zeros mean missing.
WIRE: dict[str, tuple[str, Callable, Any]] = {
    "event_type": ("ev", str, "AM"),
    "symbol": ("sym", str, ""),
    "open": ("o", float, 0.0),
    "high": ("h", float, 0.0),
    "low": ("l", float, 0.0),
    "close": ("c", float, 0.0),
    "volume": ("v", int, 0),
    "start_timestamp": ("s", int, 0),
    "end_timestamp": ("e", int, 0),
    "accumulated_volume": ("av", int, None),
    "official_open": ("op", float, None),
    "average_trade_size": ("z", float, None),
}


def bar_message(raw: Mapping[str, Any], now_ms: int | None = None) -> dict[str, Any]:
    """A vendor's compact message under the contract's names. Required numbers default to 0, which
    validation rejects later; optional ones that are 0 or missing become null; otc stays as it is."""
    out: dict[str, Any] = {}
    for name, (key, kind, missing) in WIRE.items():
        value = raw.get(key)
        out[name] = missing if value is None or (missing is None and not value) else kind(value)
    out["otc"] = raw.get("otc")
    out["ingestion_timestamp"] = int(time.time() * 1000) if now_ms is None else now_ms
    return out


def rest_bar(agg: Any, symbol: str, now_s: int) -> dict[str, Any]:
    """A minute aggregate of the REST API as a row of REST_BARS; ingestion time is in seconds."""
    extra = {k: getattr(agg, k, None) for k in ("transactions", "otc")}
    return dict.fromkeys(REST_BARS.names) | {
        "event_type": "AM",
        "symbol": symbol,
        **{k: float(getattr(agg, k)) for k in ("open", "high", "low", "close")},
        "volume": int(agg.volume),
        "start_timestamp": int(agg.timestamp),
        "end_timestamp": int(agg.timestamp) + MINUTE_MS,
        "otc": None if extra["otc"] is None else bool(extra["otc"]),
        "transactions": None if extra["transactions"] is None else int(extra["transactions"]),
        "ingestion_timestamp": int(now_s),
    }


def article(item: Any) -> dict[str, Any]:
    """A news item of the API as a row of NEWS; missing optional parts become null or empty."""
    publisher = getattr(item, "publisher", None)
    out = {k: getattr(item, k, None) for k in ("title", "description", "author", "published_utc", "article_url", "amp_url", "image_url")}
    out |= {"article_id": item.id, "tickers": list(getattr(item, "tickers", None) or []), "keywords": list(getattr(item, "keywords", None) or [])}
    out["insights"] = [{k: getattr(i, k, None) for k in ("sentiment", "sentiment_reasoning", "ticker")} for i in getattr(item, "insights", None) or []]
    for k in ("name", "homepage_url", "logo_url", "favicon_url"):
        out[f"publisher_{k}"] = getattr(publisher, k, None)
    return {k: out[k] for k in NEWS.names}


def ticker_details(item: Any) -> dict[str, Any]:
    out = {k: getattr(item, k, None) for k in TICKER_DETAILS.names}
    cap = out["market_cap"]
    return out | {"symbol": getattr(item, "ticker", None) or out["symbol"], "market_cap": None if cap is None else float(cap)}


def split(item: Any) -> dict[str, Any]:
    day = item.execution_date
    return {
        "id": item.id, "symbol": item.ticker, "execution_date": dt.date.fromisoformat(day) if isinstance(day, str) else day,
        "split_from": float(item.split_from), "split_to": float(item.split_to),
        "adjustment_type": getattr(item, "adjustment_type", None), "historical_adjustment_factor": getattr(item, "historical_adjustment_factor", None),
    }


def rows_to_df(spark: SparkSession, rows: Sequence[Mapping[str, Any]], shape=REST_BARS) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in shape.names) for r in rows], shape)


def split_rows(spark: SparkSession, items: Iterable[Any]) -> DataFrame:
    return rows_to_df(spark, [split(x) for x in items], SPLITS)


def parse_tickers(raw: str | None) -> list[str]:
    """Upper-case tickers of a comma-separated list, each once, in order; none is an error."""
    out = list(dict.fromkeys(t for t in (x.strip().upper() for x in (raw or "").split(",")) if t))
    if not out:
        raise ValueError("no tickers: expected a list like 'AAA,BBB'")
    return out


def first_present(raw: Mapping[str, Any], *keys: str) -> Any:
    """The value of the first key that is there and not null."""
    return next((raw[k] for k in keys if raw.get(k) is not None), None)


def with_retries(call: Callable[[], Any], attempts: int = 5, base_s: float = 1.0, cap_s: float = 60.0, sleep: Callable[[float], None] = time.sleep, jitter: float = 0.0) -> Any:
    """Calls again after a transient failure, waiting twice as long each time. An error with a ``status``
    that is not transient is raised at once."""
    for k in range(attempts):
        try:
            return call()
        except Exception as e:
            status = getattr(e, "status", None)
            if k == attempts - 1 or (status is not None and status not in RETRY_STATUS):
                raise
            sleep(min(cap_s, base_s * 2**k) * (1 + random.uniform(0, jitter)))


def paged(fetch: Callable[[Any], tuple[Sequence[Any], Any]], cursor: Any = None, **retries: Any) -> Iterator[Any]:
    """Items of all pages: fetch gives a page's items and the next cursor, None after the last. A page that
    fails is fetched again; items of pages before it are not."""
    while True:
        items, following = with_retries(lambda at=cursor: fetch(at), **retries)
        yield from items
        if following is None:
            return
        if following == cursor:
            raise ValueError(f"the page at {cursor!r} names itself as the next")
        cursor = following


def fetch_all(fetch: Callable[[str], list], symbols: Sequence[str], workers: int = 8) -> tuple[list, dict[str, str]]:
    """Rows of all symbols, fetched in threads, and what went wrong by symbol; one failure stops no other."""
    rows, failed = [], {}
    with ThreadPoolExecutor(max(1, min(workers, MAX_WORKERS, len(symbols) or 1))) as pool:
        for symbol, job in [(s, pool.submit(fetch, s)) for s in symbols]:
            try:
                rows += job.result()
            except Exception as e:
                failed[symbol] = f"{type(e).__name__}: {e}"
    return rows, failed


def bar_fetcher(client: Any, start_ms: int, end_ms: int, now_s: int) -> Callable[[str], list[dict]]:
    """Fetches one symbol's minute bars in [start, end): the API's end is inclusive."""
    return lambda symbol: [rest_bar(a, symbol, now_s) for a in client.list_aggs(symbol, 1, "minute", start_ms, end_ms - 1)]


def ticker_universe(active: DataFrame, *histories: DataFrame | None) -> DataFrame:
    """Active symbols and those that only history has; histories that are not there are left out."""
    out = active.select("symbol").distinct().withColumn("active", F.lit(True))
    seen = [h.select("symbol") for h in histories if h is not None]
    if not seen:
        return out
    past = seen[0]
    for s in seen[1:]:
        past = past.union(s)
    gone = past.distinct().join(active.select("symbol"), "symbol", "left_anti").withColumn("active", F.lit(False))
    return out.unionByName(gone)


def news_window(latest: dt.datetime | None, now: dt.datetime, lookback: dt.timedelta = dt.timedelta(days=1), override: tuple[dt.datetime, dt.datetime] | None = None) -> tuple[dt.datetime, dt.datetime]:
    """What to fetch: after the latest article that is stored, or a lookback, or an override."""
    return override or (latest or now - lookback, now)


def pull_news(spark: SparkSession, fetch: Callable[[dt.datetime, dt.datetime, Any], tuple[Sequence[Any], Any]], stored: DataFrame | None, now: dt.datetime, override: tuple[dt.datetime, dt.datetime] | None = None, **retries: Any) -> DataFrame:
    """New articles as NEWS rows: the window begins after the latest published_utc that is stored; an article
    that several pages hold is one row."""
    latest = None
    if stored is not None and override is None:
        said = stored.agg(F.max(F.try_to_timestamp("published_utc"))).first()[0]
        latest = None if said is None else said.replace(tzinfo=now.tzinfo)
    start, end = news_window(latest, now, override=override)
    found = {x.id: article(x) for x in paged(lambda at: fetch(start, end, at), **retries)}
    return rows_to_df(spark, list(found.values()), NEWS)


def pull_splits(spark: SparkSession, fetch: Callable[[Any], tuple[Sequence[Any], Any]], **retries: Any) -> DataFrame:
    """All splits as SPLITS rows, each id once."""
    found = {x.id: x for x in paged(fetch, **retries)}
    return split_rows(spark, found.values())


def produce_bars(
    connect: Callable[[], Iterable[Sequence[Mapping[str, Any]]]], send: Callable[[list[dict]], None], is_open: Callable[[], bool], attempts: int = 5, base_s: float = 30.0, cap_s: float = 300.0, sleep: Callable[[float], None] = time.sleep
) -> int:
    """Sends the bars of a feed while the market is open; gives how many.

    connect opens the feed and yields batches of raw messages; it may end or fail at any time and is opened
    again, after twice the wait each time, up to attempts failures in a row.  A batch that arrives resets the
    count.  Messages of other events than minute bars are left out.
    """
    sent = failures = 0
    while is_open():
        try:
            for batch in connect():
                rows = [bar_message(m) for m in batch if m.get("ev", "AM") == "AM"]
                if rows:
                    send(rows)
                sent += len(rows)
                failures = 0
                if not is_open():
                    return sent
        except (OSError, EOFError) as e:
            failures += 1
            if failures >= attempts:
                raise ConnectionError(f"the feed failed {failures} times in a row") from e
            sleep(min(cap_s, base_s * 2 ** (failures - 1)))
    return sent


class Watchlist:
    """An ordered list of symbols in a JSON file; adding twice or removing what is not there changes nothing."""

    def __init__(self, path: str | Path):
        self.path = Path(path)

    def load(self) -> list[str]:
        return json.loads(self.path.read_text()) if self.path.exists() else []

    def save(self, symbols: Sequence[str]) -> list[str]:
        kept = list(dict.fromkeys(s.strip().upper() for s in symbols if s.strip()))
        self.path.write_text(json.dumps(kept))
        return kept

    def add(self, symbol: str) -> list[str]:
        return self.save([*self.load(), symbol])

    def remove(self, symbol: str) -> list[str]:
        return self.save([s for s in self.load() if s != symbol.strip().upper()])
