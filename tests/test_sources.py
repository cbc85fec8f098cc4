"""Ingestion: flat files, storage modes, records, contract, messages, streams, pipeline registry."""

import datetime as dt
import gzip
import json
import random
from types import SimpleNamespace as Item

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barline import schemas
from barline.operators.dedup import bar_sequence, upsert_winner
from barline.plans import analytics, jobs
from barline.plans.pipeline import Pipeline
from barline.plans.rules import Expectation, ExpectationFailed
from barline.sources import contract, flatfiles, records, storage
from barline.streaming import lifecycle, messages

DAY = dt.date(2024, 1, 2)


def test_flat_file_paths():
    got = flatfiles.flat_file_paths("2024-01-05", "2024-01-08", "files", "files/stocks/minutes")
    assert got == ["s3a://files/stocks/minutes/2024/01/2024-01-05.csv.gz", "s3a://files/stocks/minutes/2024/01/2024-01-08.csv.gz"]


def test_flat_files(spark, tmp_path):
    good, bad = tmp_path / "2024-01-02.csv.gz", tmp_path / "bad.csv.gz"
    head = "ticker,volume,open,close,high,low,window_start,transactions\n"
    good.write_bytes(gzip.compress((head + "AAA,10.7,1.0,1.5,2.0,0.5,1704205800000000000,3\n").encode()))
    bad.write_bytes(gzip.compress((head + "AAA,x,1.0,1.5,2.0,0.5,1,3\n").encode()))
    found = flatfiles.existing(spark, [str(good), str(tmp_path / "absent.csv.gz")])
    assert [p for p, _ in found] == [str(good)]
    matched = flatfiles.existing(spark, [f"{tmp_path}/*.csv.gz"])
    assert sorted(p.rsplit("/", 1)[1] for p, _ in matched) == [good.name, bad.name]
    df = flatfiles.historical_bars(flatfiles.read_flat_files(spark, [str(good)]), "run")
    row = df.first()
    assert df.schema.names == schemas.HISTORICAL_BRONZE.names
    assert (row.volume, row.start_timestamp, row.end_timestamp, row.date) == (10, 1704205800000, 1704205860000, DAY)
    assert abs(row.ingestion_timestamp.timestamp() * 1000 - found[0][1]) < 1
    with pytest.raises(Exception, match="(?i)malformed"):
        flatfiles.read_flat_files(spark, [str(bad)]).collect()


def test_incremental_window():
    today = dt.date(2024, 1, 10)
    w = flatfiles.incremental_window(dt.date(2024, 1, 5), True, today)
    assert (w.first, w.last, w.days, w.up_to_date) == (dt.date(2024, 1, 6), dt.date(2024, 1, 9), 4, False)
    assert flatfiles.incremental_window(dt.date(2024, 1, 9), True, today).up_to_date
    assert flatfiles.incremental_window(None, False, today, lookback_days=3).first == dt.date(2024, 1, 7)
    assert flatfiles.incremental_window(None, False, today, override=("2023-01-01", "2023-01-02")).days == 2
    with pytest.raises(ValueError):
        flatfiles.incremental_window(None, False, today)


ROW = "symbol string, start_timestamp long, close double, date date, ingestion_timestamp timestamp, processing_timestamp timestamp, correlation_id string, source string"


def row(symbol, start, close, day=DAY):
    return (symbol, start, close, day, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3), "r", "flatfile")


def test_partition_overwrite_touches_only_its_dates(spark, tmp_path):
    t = storage.ParquetTable(spark, str(tmp_path / "t"), sort=("symbol",))
    t.create(spark.createDataFrame([row("A", 1, 1.0), row("A", 2, 2.0, dt.date(2024, 1, 3))], ROW))
    for _ in range(2):
        t.overwrite_partitions(spark.createDataFrame([row("B", 1, 9.0)], ROW))
        assert sorted((r.symbol, r.close) for r in t.read().collect()) == [("A", 2.0), ("B", 9.0)]
    history = t.history().collect()
    assert [h.operation for h in history].count("overwrite partitions") == 2 and history[-1].rows == 2
    with pytest.raises(PySparkException):
        t.create(t.read())


def test_insert_new_never_changes_a_row(spark, tmp_path):
    t = storage.ParquetTable(spark, str(tmp_path / "t"))
    t.insert_new(spark.createDataFrame([row("A", 1, 1.0)], ROW))
    done = t.insert_new(spark.createDataFrame([row("A", 1, 5.0), row("A", 2, 6.0), row("A", 2, 6.0)], ROW))
    assert done["rows"] == 1
    assert sorted((r.start_timestamp, r.close) for r in t.read().collect()) == [(1, 1.0), (2, 6.0)]
    assert t.latest() == DAY


@pytest.mark.parametrize("sort", [(), ("symbol",)])
def test_commits_without_rows_are_logged_as_such(spark, tmp_path, sort):
    t = storage.ParquetTable(spark, str(tmp_path / "t"), sort=sort)
    rows = spark.createDataFrame([row("A", n, 1.0) for n in range(40)] + [row("B", 1, 2.0, dt.date(2024, 1, 3))], ROW)
    t.create(rows.where("start_timestamp % 2 = 0"))
    assert t.insert_new(rows)["rows"] == 21
    assert [t.insert_new(rows)["rows"] for _ in range(2)] == [0, 0]
    none = rows.groupBy("symbol").count().where("count < 0").join(rows, "symbol").select(*rows.columns)
    assert [t.append(none)["rows"], t.overwrite_partitions(none)["rows"]] == [0, 0]
    assert sorted((r.symbol, r.start_timestamp) for r in t.read().collect()) == sorted((r.symbol, r.start_timestamp) for r in rows.collect())
    assert sorted(r.rows for r in t.history().collect()) == [0, 0, 0, 0, 20, 21]


def test_snapshot_replaces_its_date_only(spark, tmp_path):
    t = storage.ParquetTable(spark, str(tmp_path / "t"), ("snapshot_date",))
    day = lambda n: spark.createDataFrame([(f"s{n}", dt.date(2024, 1, n))], "symbol string, snapshot_date date")
    for n in (1, 2, 2):
        t.replace_snapshot(day(n), dt.date(2024, 1, n))
    assert sorted(r.symbol for r in t.read().collect()) == ["s1", "s2"]
    with pytest.raises(ValueError):
        t.replace_snapshot(day(1), dt.date(2024, 1, 2))


def test_alignment_and_dry_run(spark, tmp_path):
    df = spark.createDataFrame([("A", DAY)], "symbol string, date date")
    shaped = storage.aligned(df, schemas.STREAM_BRONZE)
    assert shaped.schema.names == schemas.STREAM_BRONZE.names and shaped.first().topic is None
    with pytest.raises(ValueError):
        storage.aligned(df.withColumn("surprise", F.lit(1)), schemas.STREAM_BRONZE)
    t = storage.ParquetTable(spark, str(tmp_path / "t"))
    assert storage.guarded_append(t, df)["dates"] == {"2024-01-02": 1} and not t.exists()
    storage.guarded_append(t, df, dry_run=False)
    storage.export_csv(t.read(), str(tmp_path / "csv"))
    assert t.read().count() == 1 and spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1


def test_bar_messages():
    full = {"ev": "AM", "sym": "A", "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10, "s": 1, "e": 2, "av": 5, "op": 1.1, "z": 3, "otc": True}
    assert records.bar_message(full, 7) == dict(event_type="AM", symbol="A", open=1.0, high=2.0, low=0.5, close=1.5, volume=10, start_timestamp=1, end_timestamp=2, accumulated_volume=5, official_open=1.1, average_trade_size=3.0, otc=True, ingestion_timestamp=7)
    empty = records.bar_message({"av": 0, "op": 0}, 7)
    assert (empty["open"], empty["volume"], empty["accumulated_volume"], empty["official_open"], empty["otc"], empty["symbol"]) == (0.0, 0, None, None, None, "")


def test_contract():
    schema = contract.message_schema()
    produced = set(records.bar_message({}, 1))
    assert contract.lint(schema, produced) == [] and {f["name"] for f in schema["fields"]} - produced == {"transactions"}
    broken = json.loads(json.dumps(schema))
    broken["fields"][9]["type"] = ["long", "null"]
    del broken["fields"][10]["default"]
    assert len(contract.lint(broken, produced | {"extra"})) == 3
    assert contract.backward_compatible(schema, {"fields": [*schema["fields"], {"name": "new", "type": "int"}]}) == ["new"]


def test_contract_falls_back_to_the_file(tmp_path):
    at = tmp_path / "s.avsc"
    at.write_text(json.dumps(contract.message_schema()))

    def down():
        raise OSError("no registry")

    assert contract.load_schema(at, down) == contract.load_schema(at, lambda: at.read_text()) == contract.message_schema()


def test_rest_rows(spark):
    agg = Item(timestamp=60_000, open=1, high=2, low=1, close=2, volume=5.0, transactions=None)
    got = records.rows_to_df(spark, [records.rest_bar(agg, "A", 9)]).first()
    assert (got.end_timestamp, got.volume, got.otc, got.ingestion_timestamp, got.topic if "topic" in got else None) == (120_000, 5, None, 9, None)
    calls = []
    client = Item(list_aggs=lambda s, n, unit, a, b: calls.append((s, a, b)) or ([agg] if s != "BAD" else [][1]))
    rows, failed = records.fetch_all(records.bar_fetcher(client, 0, 100, 9), ["A", "BAD", "B"], workers=99)
    assert [r["symbol"] for r in rows] == ["A", "B"] and list(failed) == ["BAD"] and calls[0][1:] == (0, 99)


def test_articles_tickers_and_splits(spark):
    item = Item(id="1", title="t", published_utc="x", tickers=None, insights=[Item(sentiment="good")], publisher=None)
    row = records.rows_to_df(spark, [records.article(item)], schemas.NEWS).first()
    assert row.tickers == [] and row.insights[0].sentiment == "good" and row.insights[0].ticker is None and row.publisher_name is None
    assert records.ticker_details(Item(ticker="A", market_cap=5))["market_cap"] == 5.0
    split = Item(id="1", ticker="A", execution_date="2024-01-02", split_from=1, split_to=2)
    assert records.split_rows(spark, [split]).first().execution_date == DAY


def test_retries():
    slept, left = [], [3]

    def flaky():
        left[0] -= 1
        if left[0]:
            raise type("Busy", (Exception,), {"status": 429})()
        return "ok"

    assert records.with_retries(flaky, sleep=slept.append) == "ok" and slept == [1.0, 2.0]

    def gone():
        raise type("Gone", (Exception,), {"status": 404})()

    with pytest.raises(Exception):
        records.with_retries(gone, sleep=slept.append)
    assert len(slept) == 2


def test_small_helpers(tmp_path):
    assert records.parse_tickers(" aapl, msft,,AAPL ") == ["AAPL", "MSFT"]
    with pytest.raises(ValueError):
        records.parse_tickers(" ,")
    assert records.first_present({"a": None, "b": 0}, "a", "b") == 0
    w = records.Watchlist(tmp_path / "w.json")
    w.add("s1"), w.add("S2"), w.add("s1"), w.remove("zzz")
    assert w.load() == ["S1", "S2"] and w.remove("S1") == ["S2"]
    now = dt.datetime(2024, 1, 2)
    assert records.news_window(None, now)[0] == dt.datetime(2024, 1, 1) and records.news_window(now, now) == (now, now)


def message(n, broken=False):
    body = b"{" if broken else json.dumps(records.bar_message({"sym": f"S{n % 3}", "o": 1, "h": 2, "l": 1, "c": 1 + n / 100, "v": 1, "s": 1704205800000 + 60_000 * (n % 7), "e": 1}, 1704206000000 + n)).encode()
    return (b"k", b"\0\0\0\0\1" + body, "bars", 0, n, dt.datetime(2024, 1, 2, 14, 30))


WIRE = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def test_messages_good_and_dead(spark):
    df = spark.createDataFrame([message(1), message(2, broken=True), (b"k", b"\0", "bars", 0, 3, None), (b"k", None, "bars", 0, 4, None)], WIRE)
    good, dead = messages.split_messages(df, "run")
    assert good.schema.names == schemas.STREAM_BRONZE.names and dead.schema.names == schemas.DEAD_LETTER.names
    row = good.collect()
    assert len(row) == 1 and row[0].ingestion_timestamp == 1704206000 and row[0].date == DAY and row[0].offset == 1
    assert sorted(r.offset for r in dead.collect()) == [2, 3, 4]
    assert messages.replay(df, 0, 10, "run").count() == 0


def test_stream_equals_batch_shuffled_and_replayed(spark, tmp_path):
    """Messages in files, in any order and some twice, end in the winner that one batch gives."""
    rows = [message(n) for n in range(60)]
    rnd = random.Random(3)
    sent = rows + rows[:30]
    rnd.shuffle(sent)
    for k in range(3):
        spark.createDataFrame(sent[k::3], WIRE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(WIRE).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    good, dead = messages.split_messages(stream, "run")
    events = storage.ParquetTable(spark, str(tmp_path / "events"))
    target = storage.ParquetTable(spark, str(tmp_path / "silver"))
    winner = lambda df: upsert_winner(df, ("symbol", "start_timestamp"), bar_sequence())
    query = lifecycle.upsert_stream(good, events, target, winner, str(tmp_path / "check"))
    query.awaitTermination(120)
    keep = ("symbol", "start_timestamp", "close", "ingestion_timestamp")
    want = winner(messages.split_messages(spark.createDataFrame(rows, WIRE), "run")[0]).select(*keep)
    assert sorted(target.read().select(*keep).collect()) == sorted(want.collect())
    folders = lifecycle.make_folders(str(tmp_path / "two"), ("streaming", "streaming_quarantine"))
    both = lifecycle.start_writers(good, dead, folders, (None, None))
    for q in both:
        q.awaitTermination(120)
    lifecycle.check_alive(both)
    assert spark.read.parquet(folders["streaming"][0]).count() == len(sent)
    assert len({c for _, c in folders.values()}) == 2


def test_drain_and_lifecycle(spark, tmp_path):
    class Fake:
        isActive, name, id, stopped, lastProgress = True, "q", 1, 0, {"numInputRows": 4}

        def __init__(self, work=lambda: None, error=None):
            self.processAllAvailable, self.error = work, error

        def exception(self):
            return self.error

        def stop(self):
            self.stopped += 1

    import threading

    nap = lambda s: None
    assert lifecycle.drain(Fake(), 5, 0, nap) == lifecycle.Drained("clean", 4)
    assert lifecycle.drain(Fake(threading.Event().wait), 0.05, 0, nap).status == "timeout"

    def boom():
        raise RuntimeError("x")

    assert lifecycle.drain(Fake(boom), 5, 0, nap).status == "error"
    assert [lifecycle.caught_up(p) for p in (None, {}, {"numInputRows": 0}, {"numInputRows": 42})] == [False, False, True, False]
    with pytest.raises(RuntimeError):
        lifecycle.watch_startup([Fake(), Fake(error="bad")], sleep=nap)
    q = Fake()
    lifecycle.stop_all([q])
    assert q.stopped == 1
    t = storage.ParquetTable(spark, str(tmp_path / "m"), ())
    lifecycle.log_drain(spark, t, "p", lifecycle.Drained("clean", 0))
    assert t.read().first().drain_status == "clean"
    times = iter([dt.datetime(2024, 7, 3, 13, 0), dt.datetime(2024, 7, 3, 13, 0), dt.datetime(2024, 7, 3, 13, 0), dt.datetime(2024, 7, 3, 13, 20)])
    naps = []
    lifecycle.run_until_close([Fake()], lambda: next(times), naps.append)
    assert naps == [60]


def test_watermark_drops_nothing_without_state(spark, tmp_path):
    spark.createDataFrame([(dt.datetime(2024, 1, 2),), (dt.datetime(2000, 1, 1),)], "t timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp").parquet(str(tmp_path / "in")).withWatermark("t", "10 minutes")
    q = stream.writeStream.format("memory").queryName("late_rows").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("late_rows").count() == 2


def test_pipeline(spark, tmp_path):
    p = Pipeline(spark, str(tmp_path))
    one = spark.createDataFrame([(1, "a", 1, DAY), (2, "b", 1, DAY)], "k int, v string, seq int, date date")

    @p.append_flow("events")
    def _(p):
        return one

    @p.append_flow("events")
    def _(p):
        return one.withColumn("v", F.lit("new")).withColumn("seq", F.lit(2)).where("k = 1")

    @p.view("events")
    def _(p):
        raise AssertionError("flows feed it")

    @p.upsert("silver", ("k",), lambda: F.col("seq"), Expectation("has_k", "k IS NOT NULL"), partition=("date",))
    def _(p):
        return p.read("events")

    @p.table("counts", Expectation("some", "n > 1", "warn"))
    def _(p):
        return p.read("silver").groupBy("v").agg(F.count("*").alias("n"))

    got = p.run("counts")["counts"]
    assert sorted((r.v, r.n) for r in got.collect()) == [("b", 1), ("new", 1)]
    assert {(r.dataset, r.name, r.failed_records) for r in p.expectation_log().collect()} == {("silver", "has_k", 0), ("counts", "some", 2)}

    @p.table("broken", Expectation("never", "n > 99"))
    def _(p):
        return p.read("counts")

    with pytest.raises(ExpectationFailed):
        p.run("broken")
    assert not p.store("broken").exists()

    @p.view("x")
    def _(p):
        return p.read("y")

    @p.view("y")
    def _(p):
        return p.read("x")

    with pytest.raises(ValueError, match="cycle"):
        p.run("x")


def test_jobs(caplog):
    log = jobs.JobLog("load")
    assert log.summary(10)["rows"] == 10 and [log.quality(n, 100)["quality"] for n in (95, 80, 79)] == ["good", "fair", "poor"]
    with pytest.raises(jobs.JobFailed):
        log.exit("failed", "no data")
    jobs.require_settings({"a": 1}, "j", {"j": ["a"]})
    with pytest.raises(ValueError, match="b"):
        jobs.require_settings({"a": 1}, "j", {"j": ["a", "b"]})


def test_versioned_cache(spark):
    version, built = ["v1"], []
    cache = analytics.VersionedCache(lambda: version[0])

    def build():
        built.append(1)
        return spark.range(3)

    assert cache.get("q", build).count() == cache.get("q", build).count() == 3 and len(built) == 1
    version[0] = "v2"
    cache.get("q", build)
    assert len(built) == 2


def test_screener_paging_and_open_ranges(spark):
    df = spark.createDataFrame([(f"S{k}", None if k == 3 else float(k)) for k in range(7)], "symbol string, x double")
    assert [r.symbol for r in analytics.page(df, "x", number=99, size=3, total=7).collect()] == ["S3"]
    assert [r.symbol for r in analytics.page(df, "symbol", size=2).collect()] == ["S0", "S1"]
    grid = spark.createDataFrame([("A", 5_000_000, None), ("B", 900_000_000, 10.0)], "symbol string, volume long, gain_1w_pct double")
    assert analytics.filter_screener(grid).count() == 2 and analytics.volume_range_is_open((0.0, 500.0))
    assert analytics.filter_screener(grid, gains={"gain_1w_pct": (-100.0, 20.0), "absent": (1.0, 2.0)}).count() == 1
    assert analytics.filter_screener(grid, volume=(0.0, 100.0)).count() == 1


def test_messages_round_trip(spark):
    rows = spark.createDataFrame([("A", 1.5, 1704205800000, 1704206000000)], "symbol string, close double, start_timestamp long, ingestion_timestamp long")
    sent = messages.as_messages(rows, 7)
    assert bytes(sent.first().value[:5]) == b"\0\0\0\0\x07" and bytes(sent.first().key) == b"A"
    wire = sent.select("*", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(1).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))
    got = messages.split_messages(wire, "run")[0].first()
    assert (got.symbol, got.close, got.start_timestamp, got.ingestion_timestamp) == ("A", 1.5, 1704205800000, 1704206000)


def test_tables_by_name_path_and_stream(spark, tmp_path):
    df = spark.createDataFrame([("A", DAY)], "symbol string, date date")
    df.write.parquet(str(tmp_path / "t"))
    df.createOrReplaceTempView("some_table")
    assert storage.table_name("a", "", "b`c") == "`a`.`b``c`"
    assert storage.catalog_table(spark, "some_table").count() == storage.path_table(spark, str(tmp_path / "t")).count() == 1
    q = storage.stream_table(spark, str(tmp_path / "t"), df.schema, 1).writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("streamed").count() == 1


def test_display_text(spark):
    from barline.functions import text

    df = spark.createDataFrame([(" a \n <b> & 'c'  ", "https://x/?a=1&b=2"), (None, "javascript:x")], "t string, u string")
    got = df.select(text.html_escaped(text.one_line(F.col("t"))).alias("t"), text.one_line(F.col("t"), 6).alias("s"), text.safe_url(F.col("u")).alias("u")).collect()
    assert [tuple(r) for r in got] == [("a &lt;b&gt; &amp; &#x27;c&#x27;", "a <b>…", "https://x/?a=1&amp;b=2"), ("", "", None)]
