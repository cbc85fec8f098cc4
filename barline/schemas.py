"""Declared schemas; nothing is inferred at ingestion."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(), "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    """A schema from "name type, ...": unlike Spark's own parser it needs no session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], name not in required) for name, kind in pairs])


#: A vendor's daily flat file: window_start counts nanoseconds, volume may be fractional.
FLAT_FILE = _struct(
    "ticker string, volume double, open double, close double, high double, low double, window_start long, transactions int",
    ("ticker", "volume", "open", "close", "high", "low", "window_start"),
)

#: Rows from the minute-aggregate REST endpoint, in the streaming table's business columns.
REST_BARS = _struct(
    "event_type string, symbol string, open double, high double, low double, close double, volume long,"
    " start_timestamp long, end_timestamp long, accumulated_volume long, official_open double,"
    " average_trade_size double, otc boolean, transactions long, ingestion_timestamp long",
    ("event_type", "symbol", "open", "high", "low", "close", "volume", "start_timestamp", "end_timestamp", "ingestion_timestamp"),
)

#: The append-only table of streamed bars; ingestion_timestamp is in epoch seconds.
STREAM_BRONZE = _struct(
    "event_type string, symbol string, open double, high double, low double, close double, volume long,"
    " start_timestamp long, end_timestamp long, accumulated_volume long, official_open double,"
    " average_trade_size double, otc boolean, transactions long, ingestion_timestamp long,"
    " kafka_ingestion_timestamp timestamp, topic string, partition int, offset long,"
    " processing_timestamp timestamp, correlation_id string, source string, ts_unit string, date date"
)

HISTORICAL_BRONZE = _struct(
    "symbol string, event_type string, open double, high double, low double, close double, volume long,"
    " start_timestamp long, end_timestamp long, ts_unit string, transactions int, otc boolean,"
    " ingestion_timestamp timestamp, processing_timestamp timestamp, correlation_id string, source string, date date"
)

DEAD_LETTER = _struct(
    "kafka_key string, raw_value binary, topic string, partition int, offset long, kafka_timestamp timestamp,"
    " quarantine_timestamp timestamp, correlation_id string, quarantine_reason string"
)

INSIGHTS = T.ArrayType(_struct("sentiment string, sentiment_reasoning string, ticker string"))

NEWS = T.StructType(
    [
        *_struct("article_id string, title string, description string, author string, published_utc string, article_url string, amp_url string, image_url string, tickers array<string>, keywords array<string>"),
        T.StructField("insights", INSIGHTS),
        *_struct("publisher_name string, publisher_homepage_url string, publisher_logo_url string, publisher_favicon_url string"),
    ]
)

TICKER_DETAILS = _struct(
    "symbol string, name string, type string, active boolean, primary_exchange string, sic_code string,"
    " sic_description string, market_cap double, list_date string",
    ("symbol",),
)

SPLITS = _struct(
    "id string, symbol string, execution_date date, split_from double, split_to double, adjustment_type string,"
    " historical_adjustment_factor double",
    ("symbol", "execution_date"),
)

#: What the message on the wire says, in the order of the contract.
BAR_MESSAGE = _struct(
    "event_type string, symbol string, open double, high double, low double, close double, volume long,"
    " start_timestamp long, end_timestamp long, accumulated_volume long, official_open double,"
    " average_trade_size double, otc boolean, transactions long, ingestion_timestamp long"
)

DRAIN_METRICS = _struct("pipeline string, drain_status string, residual_lag_rows long, captured_at timestamp")
