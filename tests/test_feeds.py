"""Avro payloads, paged pulls, the bar producer and watermarks."""

import datetime as dt
import json

import pytest
from hypothesis import given, strategies as st

from barline import schemas
from barline.operators import silver
from barline.sources import records
from barline.streaming import avro, messages

PRIMITIVES = {"string": "string", "double": "double", "bigint": "long", "int": "int", "boolean": "boolean", "float": "float", "binary": "bytes"}
SCHEMA = json.dumps({"type": "record", "name": "Bar", "fields": [{"name": f.name, "type": ["null", PRIMITIVES[f.dataType.simpleString()]]} for f in schemas.BAR_MESSAGE]})


class Item:
    def __init__(self, **k):
        self.__dict__.update(k)


@given(st.integers(-(2**63), 2**63 - 1))
def test_numbers_round_trip(n):
    assert avro.read_long(avro.write_long(n), 0) == (n, len(avro.write_long(n)))


def test_known_encodings():
    """Values that the Avro specification gives."""
    assert [avro.write_long(n) for n in (0, -1, 1, -2, 2, -64, 64)] == [b"\x00", b"\x01", b"\x02", b"\x03", b"\x04", b"\x7f", b"\x80\x01"]
    fields = [("a", ["long"]), ("b", ["string"])]
    assert avro.encode({"a": 27, "b": "foo"}, fields) == bytes.fromhex("3606666f6f")
    assert avro.encode({"b": "a"}, [("b", ["null", "string"])]) == bytes.fromhex("020261") and avro.encode({}, [("b", ["null", "string"])]) == b"\0"


def test_unreadable_payloads_are_null():
    fields = [("a", ["null", "long"]), ("b", ["string"])]
    good = avro.encode({"a": 5, "b": "xyz"}, fields)
    assert avro.decode(good, fields) == {"a": 5, "b": "xyz"}
    for bad in (None, b"", good[:-1], good + b"\0", b"\x09" + good, b"\x03" + good, b"\xff" * 20):
        assert avro.decode(bad, fields) is None
    with pytest.raises(ValueError):
        avro.encode({"a": 1}, fields)
    with pytest.raises(ValueError):
        avro.shape_of(json.dumps({"fields": [{"name": "x", "type": {"type": "array", "items": "int"}}]}))


def test_avro_messages_round_trip(spark):
    raw = [records.bar_message({"sym": f"S{k}", "o": 1.5, "h": 2, "l": 1, "c": 1.25, "v": k, "s": 1704205800000 + 60_000 * k, "e": 1, "av": k or None}, 1704206000000 + k) for k in range(5)]
    rows = spark.createDataFrame([tuple(r.get(f.name) for f in schemas.BAR_MESSAGE) for r in raw], schemas.BAR_MESSAGE)
    sent = messages.as_messages(rows, 7, SCHEMA).selectExpr("key", "value", "'bars' AS topic", "0 AS partition", "0L AS offset", "timestamp'2024-01-02' AS timestamp")
    bad = sent.limit(1).selectExpr("key", "binary('xxxxxzz') AS value", "topic", "partition", "1L AS offset", "timestamp")
    good, dead = messages.split_messages(sent.unionByName(bad), "run", avro_schema=SCHEMA)
    got = {r.symbol: r for r in good.collect()}
    assert len(got) == 5 and got["S3"].volume == 3 and got["S3"].close == 1.25 and got["S0"].accumulated_volume is None and got["S3"].ingestion_timestamp == 1704206000
    assert [r.offset for r in dead.collect()] == [1]


def pages(items, size, fail=()):
    calls = []

    def fetch(at):
        at = at or 0
        calls.append(at)
        if calls.count(at) <= list(fail).count(at):
            raise type("Busy", (Exception,), {"status": 503})()
        return items[at : at + size], at + size if at + size < len(items) else None

    return fetch, calls


def test_pages_are_fetched_once_each():
    fetch, calls = pages(list(range(10)), 4, fail=(4, 4))
    slept = []
    assert list(records.paged(fetch, sleep=slept.append)) == list(range(10))
    assert calls == [0, 4, 4, 4, 8] and slept == [1.0, 2.0]
    with pytest.raises(ValueError):
        list(records.paged(lambda at: ([1], "same"), sleep=slept.append))


def test_news_are_pulled_from_the_latest_on(spark):
    items = [Item(id=f"n{k % 5}", title=f"t{k}", published_utc="2024-01-05T00:00:00Z", tickers=["A"]) for k in range(7)]
    asked = []
    fetch, _ = pages(items, 3)

    def windowed(start, end, at):
        asked.append((start, end))
        return fetch(at)

    now = dt.datetime(2024, 1, 6)
    got = records.pull_news(spark, windowed, None, now)
    assert sorted(r.article_id for r in got.collect()) == [f"n{k}" for k in range(5)] and set(asked) == {(dt.datetime(2024, 1, 5), now)}
    asked.clear()
    records.pull_news(spark, windowed, got, now)
    assert set(asked) == {(dt.datetime(2024, 1, 5), now)} and got.columns == schemas.NEWS.names
    assert records.pull_news(spark, lambda *_: ([], None), got, now).count() == 0


def test_splits_are_pulled(spark):
    items = [Item(id=str(k % 4), ticker="A", execution_date="2024-01-02", split_from=1, split_to=2) for k in range(9)]
    assert sorted(r.id for r in records.pull_splits(spark, pages(items, 2)[0]).collect()) == ["0", "1", "2", "3"]


def test_the_producer_connects_again():
    opened, sent, slept, left = [], [], [], [8]

    def connect():
        opened.append(len(opened))
        if len(opened) in (1, 2):
            raise ConnectionError
        yield [{"ev": "AM", "sym": "A", "c": 1}, {"ev": "status"}]
        if len(opened) == 3:
            raise EOFError
        yield [{"sym": "B"}]

    def is_open():
        left[0] -= 1
        return left[0] > 0

    n = records.produce_bars(connect, sent.append, is_open, sleep=slept.append)
    assert n == sum(map(len, sent)) >= 3 and slept == [30.0, 60.0, 30.0] and sent[0][0]["symbol"] == "A"

    def never():
        raise OSError
        yield

    slept.clear()
    with pytest.raises(ConnectionError):
        records.produce_bars(never, sent.append, lambda: True, sleep=slept.append)
    assert slept == [30.0, 60.0, 120.0, 240.0]
    assert records.produce_bars(never, sent.append, lambda: False) == 0


def test_streams_have_watermarks_and_late_rows_arrive(spark, tmp_path):
    shape = "symbol string, start_timestamp long, ts_unit string, otc boolean"
    rows = [("A", 1_704_205_800_000, "ms", None), ("B", 1_000, "ms", False), ("C", 1_704_205_800_000, "ms", True)]
    spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/in")
    stream = silver.unified(spark.readStream.schema(shape).parquet(f"{tmp_path}/in"))
    assert "EventTimeWatermark" in stream._jdf.queryExecution().analyzed().toString()
    q = stream.writeStream.format("memory").queryName("late_bars").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.symbol for r in spark.table("late_bars").collect()) == ["A", "B"]
    batch = spark.createDataFrame(rows, shape)
    assert silver.bars_with_lateness(batch) is batch
    assert silver.news_with_lateness(spark.readStream.schema("published_utc string").parquet(f"{tmp_path}/in")).columns == ["published_utc"]
