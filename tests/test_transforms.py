"""Bars: roll-up, dedup, rules, audit, splits, metrics, calendar."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barline.functions import calendar, classify, timeunits
from barline.operators import audit, dedup, dims, facts, indicators, metrics, quarantine, rollup, silver, splits
from barline.plans import rules

BAR = "symbol string, date date, start_timestamp long, end_timestamp long, open double, high double, low double, close double, volume long, source string, ts_unit string, otc boolean, ingestion_timestamp timestamp"
DAY = dt.date(2024, 1, 2)
NOON = dt.datetime(2024, 1, 2, 12)


def bar(symbol="AAA", start=1_700_000_000_000, o=10.0, h=12.0, low=9.0, c=11.0, v=100, source="flatfile", ingested=NOON, day=DAY, **more):
    row = dict(symbol=symbol, date=day, start_timestamp=start, end_timestamp=start + 60_000, open=o, high=h, low=low, close=c, volume=v, source=source, ts_unit="ms", otc=None, ingestion_timestamp=ingested) | more
    return tuple(row.values())


def bars(spark, *rows):
    return spark.createDataFrame(list(rows), BAR)


def test_daily_rollup(spark):
    rows = [bar("AAPL", 1000 + i, 150.0 + i, 152.0 + i, 149.0 + i, 151.0 + i, 1_000_000 + 100 * i) for i in range(5)]
    random.Random(1).shuffle(rows)
    got = rollup.daily_bars(bars(spark, *rows)).first()
    assert (got.open, got.high, got.low, got.close, got.volume) == (150.0, 156.0, 149.0, 155.0, 5_001_000)


def test_rollup_is_a_hash_aggregate(spark):
    plan = rollup.daily_bars(bars(spark, bar()))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_refresh_of_changed_groups_when_the_high_goes(spark):
    old = bars(spark, bar(start=1), bar(start=2, h=99.0), bar("BBB", 1))
    new = bars(spark, bar(start=1), bar(start=2), bar("BBB", 1))
    daily = rollup.daily_bars(old)
    got = rollup.refreshed(daily, new, bars(spark, bar(start=2)))
    assert {(r.symbol, r.high) for r in got.collect()} == {("AAA", 12.0), ("BBB", 12.0)}


def test_flat_file_beats_a_later_stream_row_in_any_order(spark):
    early = bar(c=11.0, ingested=dt.datetime(2024, 1, 1))
    late = bar(c=10.5, source="stream", ingested=dt.datetime(2024, 2, 1))
    for rows in ((early, late), (late, early), (late, early, late, early)):
        got = silver.silver_bars(silver.enriched_bars(bars(spark, *[r[:2] + (1704207600000, 1704207660000) + r[4:] for r in rows]))).collect()
        assert [(r.close, r.source) for r in got] == [(11.0, "flatfile")]


def test_upsert_keeps_what_a_later_null_would_hide(spark):
    df = spark.createDataFrame([(1, "a", None, 1), (1, None, "y", 2), (1, "b", None, 3)], "k int, x string, y string, seq int")
    got = dedup.upsert_winner(df, ("k",), F.col("seq")).first()
    assert (got.x, got.y, got.seq) == ("b", "y", 3)
    assert dedup.upsert_winner(df, ("k",), F.col("seq"), ignore_nulls=False).first().y is None


def test_latest_ingested_is_idempotent(spark):
    df = bars(spark, bar(c=10.0), bar(c=10.5)).withColumn("processing_timestamp", F.lit(NOON)).withColumn("correlation_id", F.when(F.col("close") == 10.0, "run-002").otherwise("run-010"))
    once = dedup.latest_ingested(df)
    assert once.first().correlation_id == "run-010" and once.count() == 1
    assert dedup.latest_ingested(once).collect() == once.collect()


@pytest.mark.parametrize("change, reason", [({"c": 0.0}, "invalid_price_positive"), ({"c": 200.0}, "invalid_ohlc_logic"), ({"v": -1}, "invalid_volume"), ({"c": 0.0, "v": -1, "low": 50.0}, "invalid_price_positive")])
def test_rejection_precedence(spark, change, reason):
    got = quarantine.bar_quarantine(bars(spark, bar(**change), bar(**change))).collect()
    assert [r.rejection_reason for r in got] == [reason]


def test_a_null_price_is_neither_kept_nor_rejected_unless_strict(spark):
    df = bars(spark, bar(c=None))
    assert df.where(rules.all_valid(rules.BAR_RULES)).count() == 0 and quarantine.bar_quarantine(df).count() == 0
    log = audit.audit_log(df).first()
    assert (log.total_count, log.rejected_count, log.valid_count) == (1, 0, 1)
    assert quarantine.bar_quarantine(df, strict=True).count() == 1 and audit.audit_log(df, strict=True).first().rejected_count == 1


@pytest.mark.parametrize("rejected, passed, warned", [(3, True, False), (5, True, True), (6, True, True), (10, False, True), (12, False, True)])
def test_gate(spark, rejected, passed, warned):
    got = audit.gate(spark.createDataFrame([(DAY, 1000, rejected)], "audit_date date, total_count long, rejected_count long")).first()
    assert (got.quality_gate_passed, got.quality_gate_warning) == (passed, warned)


def test_gate_of_an_empty_day_and_old_failures(spark):
    assert audit.gate(spark.createDataFrame([(DAY, 0, 0)], "audit_date date, total_count long, rejected_count long")).first().rejection_rate_pct == 0.0
    df = spark.createDataFrame([(dt.date(2024, 1, 1), False, 100), (dt.date(2024, 1, 9), False, None)], "audit_date date, quality_gate_passed boolean, session_bars long")
    got = {r.name: r.failed_records for r in rules.violations(df, *rules.audit_expectations(dt.date(2024, 1, 10))).collect()}
    assert got == {"quality_gate": 1, "session_complete": 0}


def test_session_bars_outside_the_recent_window_are_null(spark):
    df = bars(spark, bar(), bar(day=dt.date(2024, 1, 3)))
    got = {r.audit_date.day: r.session_bars for r in audit.audit_log(df, recent=df.where("date > '2024-01-02'")).collect()}
    assert got == {2: None, 3: 1}


SPLIT = "symbol string, execution_date date, split_from double, split_to double, adjustment_type string, historical_adjustment_factor double"
DAILY = "symbol string, date date, open double, high double, low double, close double, volume long"


def test_split_adjustment(spark):
    told = spark.createDataFrame([("AAPL", dt.date(2020, 8, 31), 1.0, 2.0, "forward", 0.5), ("TSLA", dt.date(2020, 1, 10), 10.0, 1.0, "reverse", 10.0), ("BAD", DAY, 1.0, 1.0, "x", None)], SPLIT)
    dimension = splits.split_dimension(told)
    rows = [("AAPL", dt.date(2020, 8, 28), 500.0, 500.0, 500.0, 500.0, 1000), ("AAPL", dt.date(2020, 8, 31), 250.0, 250.0, 250.0, 250.0, 1000), ("TSLA", dt.date(2020, 1, 9), 1.0, 1.0, 1.0, 1.0, 5000), ("MSFT", dt.date(2020, 1, 9), 7.0, 7.0, 7.0, 7.0, 1)]
    for limit in (1 << 30, -1):  # broadcast, and shuffled
        got = {(r.symbol, r.date.day): (r.close, r.adj_close, r.adj_volume) for r in splits.adjusted(spark.createDataFrame(rows, DAILY), dimension, limit).collect()}
        assert got == {("AAPL", 28): (500.0, 250.0, 2000), ("AAPL", 31): (250.0, 250.0, 1000), ("TSLA", 9): (1.0, 10.0, 500), ("MSFT", 9): (7.0, 7.0, 1)}


def test_several_splits_and_repeats_of_one(spark):
    told = spark.createDataFrame([("A", dt.date(2020, 1, 10), 1.0, 2.0, "f", 0.1), ("A", dt.date(2020, 2, 10), 1.0, 5.0, "f", 0.2), ("A", dt.date(2020, 2, 10), 1.0, 5.0, "f", 0.2)], SPLIT)
    dimension = splits.split_dimension(told)
    days = [dt.date(2020, 1, 9), dt.date(2020, 1, 10), dt.date(2020, 2, 9), dt.date(2020, 2, 10), dt.date(2020, 2, 11)]
    df = spark.createDataFrame([("A", d, 100.0, 100.0, 100.0, 100.0, 10) for d in days], DAILY)
    for limit in (1 << 30, -1):
        got = [r.price_factor for r in splits.adjusted(df, dimension, limit).orderBy("date").collect()]
        assert got == [0.1, 0.2, 0.2, 1.0, 1.0]
    segments = sorted((r.valid_from is None, r.valid_to.month, r.factor) for r in splits.factor_segments(dimension).collect())
    assert segments == [(False, 2, 0.2), (True, 1, 0.1)]


def series(spark, n, volume=None, symbol="A"):
    rows = [(symbol, dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + i, (volume or {}).get(i, 1000)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, adj_close double, adj_volume long")


def test_lag_anchors(spark):
    got = metrics.daily_metrics(series(spark, 30).unionByName(series(spark, 3, symbol="B"))).orderBy("symbol", "date").collect()
    last = got[29]
    assert (last.close_5d, last.close_21d, last.close_63d, last.prev_adj_close) == (124.0, 108.0, None, 128.0)
    assert got[4].close_5d is None and got[30].prev_adj_close is None


def test_relative_volume_is_gated(spark):
    got = metrics.daily_metrics(series(spark, 22, {21: 3000})).orderBy("date").collect()
    assert [got[k].rvol_20d for k in (19, 20, 21)] == [None, 1.0, 3.0]
    gap = metrics.daily_metrics(series(spark, 22, {5: None})).orderBy("date").collect()
    assert gap[20].rvol_20d is None


def test_metrics_need_one_shuffle_sort_and_window(spark):
    plan = metrics.daily_metrics(series(spark, 5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") <= 2 and plan.count("Sort [") == 1


def test_winner_is_limited_before_the_shuffle(spark):
    df = bars(spark, bar()).withColumn("processing_timestamp", F.lit(None).cast("timestamp")).withColumn("correlation_id", F.lit("x"))
    assert "WindowGroupLimit" in dedup.latest_ingested(df)._jdf.queryExecution().executedPlan().toString()


def test_small_segments_are_broadcast(spark, tmp_path):
    spark.createDataFrame([("A", DAY, 1.0, 2.0, "f", 0.5)], SPLIT).write.parquet(str(tmp_path / "splits"))
    told = splits.split_dimension(spark.read.parquet(str(tmp_path / "splits")))
    plan = splits.adjusted(spark.createDataFrame([("A", DAY, 1.0, 1.0, 1.0, 1.0, 1)], DAILY), told)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_market_hours_are_half_open_with_daylight_saving_and_early_closes(spark):
    utc = lambda *x: int(dt.datetime(*x, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [
        bar(start=utc(2024, 1, 2, 14, 29)), bar(start=utc(2024, 1, 2, 14, 30)), bar(start=utc(2024, 1, 2, 20, 59)), bar(start=utc(2024, 1, 2, 21, 0)),
        bar(start=utc(2024, 7, 1, 13, 30)), bar(start=utc(2024, 7, 1, 20, 0)), bar(start=utc(2024, 7, 3, 16, 59)), bar(start=utc(2024, 7, 3, 17, 0)),
    ]
    early = calendar.early_close_sessions(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    got = sorted(r.start_timestamp for r in silver.in_market_hours(bars(spark, *rows), early).collect())
    assert got == sorted(r[2] for r in (rows[1], rows[2], rows[4], rows[6]))


def test_over_the_counter_bars_go(spark):
    assert [r.otc for r in silver.exchange_traded(bars(spark, bar(otc=True), bar(otc=False), bar(otc=None))).collect()] == [False, None]


def test_calendar():
    year = calendar.holidays(2024)
    assert {dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 2, 19), dt.date(2024, 3, 29), dt.date(2024, 5, 27), dt.date(2024, 6, 19), dt.date(2024, 7, 4), dt.date(2024, 9, 2), dt.date(2024, 11, 28), dt.date(2024, 12, 25)} == year
    assert len(calendar.trading_days(dt.date(2024, 1, 1), dt.date(2024, 12, 31))) == 252
    assert len(calendar.trading_days(dt.date(2023, 1, 1), dt.date(2023, 12, 31))) == 250
    assert calendar.is_trading_day(dt.date(2021, 12, 31)) and not calendar.is_trading_day(dt.date(2023, 1, 2))
    assert not calendar.is_trading_day(dt.date(2021, 7, 5)) and not calendar.is_trading_day(dt.date(2022, 6, 20)) and calendar.is_trading_day(dt.date(2021, 6, 18))
    assert calendar.early_closes(2024) == {dt.date(2024, 7, 3), dt.date(2024, 11, 29), dt.date(2024, 12, 24)}
    assert calendar.early_closes(2021) == {dt.date(2021, 11, 26)}
    # Good Friday 2019 was the third Friday of April.
    assert dt.date(2019, 4, 18) in calendar.option_expiries(dt.date(2019, 4, 1), dt.date(2019, 4, 30))
    at = lambda h, m, d=3: dt.datetime(2024, 7, d, h, m)
    assert calendar.is_market_hours(at(9, 30)) and calendar.is_market_hours(at(12, 59)) and not calendar.is_market_hours(at(13, 0)) and not calendar.is_market_hours(at(10, 0, 4))
    assert calendar.shutdown_time(at(10, 0)) == at(13, 20) and calendar.should_stop_streaming(at(13, 20)) and not calendar.should_stop_streaming(at(13, 19))
    assert [calendar.poll_seconds(s) for s in (1801, 1800, 301, 300)] == [300, 60, 60, 10]


def test_epoch_units(spark):
    df = spark.createDataFrame([(1_700_000_000, "s"), (1_700_000_000_999, "ms"), (1_700_000_000_999_999_999, "ns"), (1, "us"), (1_704_085_200_000, "ms")], "t long, u string")
    got = df.select(timeunits.epoch_seconds(F.col("t"), F.col("u")).alias("s"), timeunits.market_date(F.col("t"), F.col("u")).alias("d")).collect()
    assert [r.s for r in got] == [1_700_000_000] * 3 + [None, 1_704_085_200] and got[3].d is None and got[4].d == dt.date(2024, 1, 1)


def test_epoch_window_and_ranges():
    assert timeunits.epoch_window("2024-01-02", "09:30", "10:00") == (1704205800000, 1704207600000)
    assert timeunits.epoch_window("2024-07-01", "09:30", "10:00")[0] == 1719840600000
    for bad in (("10:00", "09:30"), ("9", "10:00"), ("09:30", "09:30")):
        with pytest.raises(ValueError):
            timeunits.epoch_window("2024-01-02", *bad)
    today = dt.date(2024, 5, 20)
    assert timeunits.relative_range("last quarter", today) == (dt.date(2024, 1, 1), dt.date(2024, 3, 31))
    assert timeunits.relative_range("ytd", today)[0] == dt.date(2024, 1, 1) and timeunits.relative_range("30 days", today)[0] == dt.date(2024, 4, 20)
    assert [timeunits.fetch_days(n) for n in (10, 421, 1876)] == [420, 1875, 1890]


def test_normalised_times(spark):
    df = spark.createDataFrame([("1704205800000",), ("2024-01-02 14:30:00",), ("what",), (None,)], "x string")
    got = [r[0] for r in df.select(timeunits.normalised_market_time(F.col("x"))).collect()]
    assert got == [dt.datetime(2024, 1, 2, 9, 30)] * 2 + [None, None]


def test_classification(spark):
    df = spark.createDataFrame([("3571", "CS", None, 3e11), ("7372", "CS", "SOFTWARE", 2e11), (None, "ETF", None, None), ("0300", "CS", None, 1.0), ("6500", None, None, 50e6)], "sic string, type string, d string, cap double")
    got = df.select(classify.sector(F.col("sic"), F.col("type")).alias("s"), classify.industry(F.col("d"), F.col("type")).alias("i"), classify.cap_tier(F.col("cap")).alias("c")).collect()
    assert [r.s for r in got] == ["Industrial Machinery", "Business Services", "Financial Services", "Other", "Real Estate"]
    assert [r.i for r in got] == [None, "SOFTWARE", "Exchange Traded Fund", None, None]
    assert [r.c for r in got] == ["Mega Cap", "Large Cap", "Unknown", "Nano Cap", "Nano Cap"]
    labels = spark.createDataFrame([(1.5e9,), (-2.5e6,), (12_345.0,), (7.0,), (None,)], "x double").select(classify.compact_number(F.col("x"), "$"))
    assert [r[0] for r in labels.collect()] == ["$1.50B", "-$2.50M", "$12K", "$7", "$0"]


def test_snapshots(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 5))], "symbol string, snapshot_date date")
    assert [r.symbol for r in dims.latest_snapshot(df, dt.date(2024, 1, 5)).collect()] == ["b"]
    with pytest.raises(ValueError):
        dims.latest_snapshot(df.limit(0))
    with pytest.raises(ValueError):
        dims.latest_snapshot(df, dt.date(2023, 12, 1))
    assert dims.duplicate_keys(df.union(df), "symbol").count() == 2 and [r.symbol for r in dims.missing_parents(df, df.where("symbol = 'a'"), "symbol").collect()] == ["b"]


def test_expectations_fail_warn_and_drop(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a int, b int")
    checked = rules.expect(df, "t", rules.Expectation("a", "a IS NOT NULL", "drop"), rules.Expectation("b", "b > 0", "warn"), rules.Expectation("c", "a > 0 OR b > 0"))
    assert checked.df.count() == 2
    assert {x["name"]: x["failed_records"] for x in checked.verify()} == {"a": 1, "b": 1, "c": 0}
    bad = rules.expect(df, "t", rules.Expectation("b", "b > 0"))
    bad.df.count()
    with pytest.raises(rules.ExpectationFailed):
        bad.verify()


def test_news_fact_explodes_once_for_each_pair(spark):
    rows = [("1", ["A", "A", None, "B"], DAY, "x" * 900), ("2", None, DAY, "d"), ("3", [], DAY, "d"), ("4", ["A"], DAY, None)]
    df = spark.createDataFrame(rows, "article_id string, tickers array<string>, published_date date, cleaned_description string")
    df = df.withColumn("title", F.lit(" raw ")).withColumn("description", F.lit(" raw ")).withColumn("cleaned_title", F.lit("clean"))
    for c in ("published_utc", "article_url", "publisher_name", "author"):
        df = df.withColumn(c, F.lit("x"))
    got = facts.news_fact(df).collect()
    assert sorted((r.article_id, r.symbol, r.title, len(r.description)) for r in got) == [("1", "A", "clean", 500), ("1", "B", "clean", 500), ("4", "A", "clean", 0)]


def test_minute_retention_has_a_floor(spark):
    with pytest.raises(ValueError):
        facts.minute_fact(bars(spark, bar()), DAY, 4)


def plain_profile(highs, lows, volumes):
    """The profile by a plain loop."""
    lo, hi = min(lows), max(highs)
    spans = sorted(h - low for h, low in zip(highs, lows))
    mid = len(spans) // 2
    typical = spans[mid] if len(spans) % 2 else (spans[mid - 1] + spans[mid]) / 2
    n = min(max(round((hi - lo) / ((typical if typical > 0 else (hi - lo) / 50) / 2)), 20), 100)
    size, held = (hi - lo) / n, [0.0] * n
    for h, low, v in zip(highs, lows, volumes):
        a, b = (min(max(int((x - lo) / size), 0), n - 1) for x in (low, h))
        for k in range(a, b + 1):
            held[k] += v / (b - a + 1)
    down = up = held.index(max(held))
    area = held[down]
    while area < 0.7 * sum(held) and (down > 0 or up < n - 1):
        below, above = sum(held[max(down - 2, 0) : down]), sum(held[up + 1 : up + 3])
        if (above >= below and up < n - 1) or down == 0:
            area += above
            up = min(up + 2, n - 1)
        else:
            area += below
            down = max(down - 2, 0)
    return n, lo + down * size, lo + (up + 1) * size


def test_volume_profile_is_what_a_loop_gives(spark):
    rnd, rows, want = random.Random(4), [], {}
    for s in range(12):
        lows = [round(rnd.uniform(10, 20), 2) for _ in range(rnd.randint(2, 60))]
        highs = [round(x + rnd.choice([0.0, 0.5, 3.0]) * rnd.random(), 2) for x in lows]
        volumes = [rnd.randint(1, 1000) for _ in lows]
        rows += [(f"S{s}", h, low, v) for h, low, v in zip(highs, lows, volumes)]
        want[f"S{s}"] = plain_profile(highs, lows, volumes)
    df = spark.createDataFrame([*rows, ("FLAT", 1.0, 1.0, 5), ("NONE", None, 1.0, 5)], "symbol string, high double, low double, volume long")
    got = {r.symbol: (r.n_bins, r.value_area_low, r.value_area_high) for r in indicators.volume_profile(df).collect()}
    assert set(got) == set(want)
    for s, (n, a, b) in want.items():
        assert got[s][0] == n and abs(got[s][1] - a) < 1e-9 and abs(got[s][2] - b) < 1e-9
