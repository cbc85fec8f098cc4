"""As-of joins, incremental refresh, sketches, Bloom filters and pages: results, and what plans must not do."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barline.operators import asof, bloom, facts, incremental, paging, sketches, splits
from barline.sources.storage import ParquetTable, bucketed_table

START = dt.date(2020, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def quotes(seed, n, symbols="ABC"):
    rnd = random.Random(seed)
    return [(rnd.choice(symbols) if rnd.random() > 0.05 else None, START + dt.timedelta(days=rnd.randint(0, 400)) if rnd.random() > 0.05 else None, k) for k in range(n)]


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_as_of_is_what_trying_all_gives(spark, forward, strict):
    left, right = quotes(1, 150, "AAAAAAB"), quotes(2, 40)
    got = asof.as_of(spark.createDataFrame(left, "s string, d date, id int"), spark.createDataFrame(right, "s string, at date, v int"), ["s"], "d", "at", ["at", "v"], forward, strict)

    def best(s, d):
        fits = [(at, v) for x, at, v in right if s is not None and x == s and d is not None and at is not None and ((at > d or (at == d and not strict)) if forward else (at < d or (at == d and not strict)))]
        return ((min if forward else max)(fits) if fits else (None, None))

    assert sorted(map(tuple, got.select("id", "s", "d", "at", "v").collect()), key=str) == sorted(((k, s, d, *best(s, d)) for s, d, k in left), key=str)
    assert "Broadcast" not in plan(got) and "date_trunc" in plan(got)


def test_a_hot_symbol_is_several_tasks(spark):
    """The window's key has the month, so the bars of one symbol are dealt by month."""
    bars = spark.range(3000).select(F.lit("HOT").alias("symbol"), F.date_add(F.lit(START), (F.col("id") % 700).cast("int")).alias("date"), *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).alias("volume"))
    told = spark.createDataFrame([("HOT", START + dt.timedelta(days=300), 0.5)], "symbol string, execution_date date, historical_adjustment_factor double")
    out = splits.adjusted(bars, told, broadcast_bytes=-1)
    assert out.groupBy("price_factor").count().count() == 2 and out.count() == 3000
    exchanges = [x for x in plan(out).splitlines() if "Exchange hashpartitioning(symbol" in x]
    assert exchanges and any("__part" in x for x in exchanges) and "Broadcast" not in plan(out)


DAILY = "symbol string, date date, open double, high double, low double, close double, volume long"
SPLITS = "symbol string, execution_date date, historical_adjustment_factor double"


def sessions(n=600, symbols=("A", "B", "C")):
    rnd = random.Random(5)
    return [(s, START + dt.timedelta(days=k), *[round(rnd.uniform(5, 9), 2) for _ in range(4)], rnd.randint(1, 900)) for s in symbols for k in range(n)]


def full(spark, rows, told):
    return facts.adjusted_daily_fact(spark.createDataFrame(rows, DAILY), spark.createDataFrame(told, SPLITS))


def test_refresh_equals_the_full_derivation_and_leaves_other_partitions(spark, tmp_path):
    rows, told = sessions(), [("A", START + dt.timedelta(days=200), 0.5), ("B", START + dt.timedelta(days=500), 0.1)]
    before = [r for r in rows if not (r[0] == "A" and r[1] == START + dt.timedelta(days=100))]
    added = [r for r in rows if r not in before]
    after = [r for r in rows if not (r[0] == "C" and r[1] == START + dt.timedelta(days=5))]
    removed = [r for r in rows if r not in after]
    new_told = [*told, ("C", START + dt.timedelta(days=20), 0.25)]
    table = ParquetTable(spark, str(tmp_path / "f"), ("month",), ("symbol", "date"))
    table.create(incremental.with_partition(full(spark, before, told), "month"))
    times = {p: p.stat().st_mtime_ns for p in (tmp_path / "f").glob("month=*/*.parquet")}
    changed = spark.createDataFrame([r[:2] for r in added + removed], "symbol string, date date")
    daily, known = spark.createDataFrame(after, DAILY), spark.createDataFrame(new_told, SPLITS)
    entry = incremental.refresh(table, daily, known, changed, known.where("symbol = 'C'"))
    want = incremental.with_partition(full(spark, after, new_told), "month")
    assert sorted(map(str, table.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    untouched = [p for p in times if p.exists() and p.stat().st_mtime_ns == times[p]]
    months = {p.parent.name for p in untouched}
    assert len(entry["partitions"]) < 16 and "month=2021-08-01" in months and len(months) + len(entry["partitions"]) == len({p.parent.name for p in times})
    # Again: nothing has changed, and the same rows come out.
    incremental.refresh(table, daily, known, changed, known.where("symbol = 'C'"))
    assert sorted(map(str, table.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert incremental.refresh(table, daily, known, changed.limit(0), known.limit(0))["rows"] == 0


def test_large_tables_are_made_and_refreshed_in_turns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "PIECE_BYTES", 1)
    monkeypatch.setattr(incremental, "PIECES", 3)
    monkeypatch.setattr(incremental, "TURN_ROWS", 150)
    monkeypatch.setattr(incremental, "TURNS", 50)
    rows, told = sessions(), [("A", START + dt.timedelta(days=200), 0.5)]
    minutes = spark.createDataFrame([(*r[:2], 1, *r[2:]) for r in rows], DAILY.replace("date date,", "date date, start_timestamp long,"))
    table = ParquetTable(spark, str(tmp_path / "f"), ("month",), ("symbol", "date"))
    files = lambda: {f.getName() for f in map(lambda k: found.apply(k), range(found.size())) if f.getName().startswith("shuffle_")}
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    before = files()
    incremental.create(table, minutes, spark.createDataFrame(told, SPLITS))
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    assert files() <= before  # a commit's shuffles go with it
    months = lambda rows: sorted(map(str, rows.collect()))
    want = incremental.with_partition(full(spark, rows, told), "month")
    assert months(table.read().select(*want.columns)) == months(want)
    assert [r.operation for r in table.history().orderBy("at").collect()] == ["create", "append", "append"]
    told = [*told, ("B", START + dt.timedelta(days=500), 0.1)]
    new = [r for r in rows if r[:2] != ("C", START + dt.timedelta(days=300))]
    known, changed = spark.createDataFrame(told, SPLITS), spark.createDataFrame([("C", START + dt.timedelta(days=300))], "symbol string, date date")
    entry = incremental.refresh(table, spark.createDataFrame(new, DAILY), known, changed, known.where("symbol = 'B'"))
    want = incremental.with_partition(full(spark, new, told), "month")
    assert months(table.read().select(*want.columns)) == months(want)
    turns = [r.rows for r in table.history().collect() if r.operation == "overwrite partitions"]
    assert len(turns) > 4 and max(turns) <= 150 and sum(turns) == entry["rows"]


def test_turns_hold_neighbours_up_to_a_size(monkeypatch):
    monkeypatch.setattr(incremental, "TURN_ROWS", 10)
    assert incremental._turns({3: 4, 1: 5, 2: 5, 4: 30, 5: 1}) == [[1, 2], [3], [4], [5]]
    assert len(incremental._turns(dict.fromkeys(range(100), 1000))) <= 2 * incremental.TURNS


def test_daily_bars_need_one_shuffle_and_only_the_days_asked_for(spark):
    from barline import testdata
    from barline.operators import rollup

    rows = rollup.daily_bars(testdata.minute_bars(spark, "/root/testdata/sf0.001")).where("date between '2001-03-05' and '2001-03-09'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Filter") > plan.index("Exchange")


def test_refresh_removes_a_partition_that_has_no_rows_any_more(spark, tmp_path):
    rows = sessions(3, ("A",))
    table = ParquetTable(spark, str(tmp_path / "f"), ("date",), ("symbol",))
    table.create(full(spark, rows, []))
    gone = spark.createDataFrame([rows[2][:2]], "symbol string, date date")
    incremental.refresh(table, spark.createDataFrame(rows[:2], DAILY), spark.createDataFrame([], SPLITS), gone, spark.createDataFrame([], SPLITS))
    assert sorted(r.date for r in table.read().collect()) == [r[1] for r in rows[:2]]


def test_refresh_keeps_other_rows_of_a_partition_that_only_loses_some(spark, tmp_path):
    rows = sessions(3, ("A", "B"))
    table = ParquetTable(spark, str(tmp_path / "f"), ("date",), ("symbol",))
    table.create(full(spark, rows, []))
    left = [r for r in rows if r[:2] != rows[2][:2]]
    incremental.refresh(table, spark.createDataFrame(left, DAILY), spark.createDataFrame([], SPLITS), spark.createDataFrame([rows[2][:2]], "symbol string, date date"), spark.createDataFrame([], SPLITS))
    assert sorted((r.symbol, r.date) for r in table.read().collect()) == [r[:2] for r in left]


def test_only_what_is_reached_is_derived(spark):
    daily = spark.createDataFrame(sessions(1000, ("A", "B")), DAILY)
    changed = spark.createDataFrame([("A", START + dt.timedelta(days=500))], "symbol string, date date")
    keys = incremental.reached(daily, changed, spark.createDataFrame([], SPLITS))
    assert {r.symbol for r in keys.collect()} == {"A"} and keys.where("affected").count() == incremental.REACH + 1 and keys.count() == 2 * incremental.REACH + 1


def test_sketches_of_days_unite_within_the_bound(spark):
    rows = spark.range(60_000).select((F.col("id") % 17_000).alias("v"), F.date_add(F.lit(START), (F.col("id") % 30).cast("int")).alias("date"))
    days = sketches.daily_sketches(rows, "v")
    got = days.agg(sketches.distinct_count().alias("n"), F.sum("rows").alias("rows")).first()
    assert abs(got.n - 17_000) <= 17_000 * sketches.relative_error() and got.rows == 60_000
    # A day that is read again replaces its sketch: the same days give the same estimate.
    again = days.where("date <> '2020-01-05'").unionByName(sketches.daily_sketches(rows.where("date = '2020-01-05'"), "v"))
    assert again.agg(sketches.distinct_count().alias("n")).first().n == got.n
    some = days.where("date < '2020-01-04'").agg(sketches.distinct_count().alias("n")).first().n
    true = rows.where("date < '2020-01-04'").select("v").distinct().count()
    assert abs(some - true) <= true * sketches.relative_error()


@pytest.mark.parametrize("k", [8, 4000])
def test_percentiles_are_exact_even_with_a_coarse_sketch(spark, k):
    rnd = random.Random(3)
    rows = [(g, rnd.choice([1.0, 2.5, rnd.random(), None, -7.0])) for g in "abc" for _ in range(400)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = [0.0, 0.1, 0.5, 0.7, 0.93, 1.0]
    got = {(r.g, r.share): r.value for r in sketches.exact_percentiles(df, "v", shares, ("g",), k).collect()}
    want = {(r.g, s): x for r in df.groupBy("g").agg(F.percentile("v", shares).alias("p")).collect() if r.p for s, x in zip(shares, r.p)}
    assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-12 for x in want)
    total = {r.share: r.value for r in sketches.exact_percentiles(df, "v", shares, k=k).collect()}
    assert total == pytest.approx(dict(zip(shares, df.agg(F.percentile("v", shares)).first()[0])))


def test_bloom_joins_equal_plain_ones_and_shuffle_less(spark):
    target = spark.range(0, 4000, 2).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("s"))
    batch = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("s"), F.lit("x").alias("v")).unionByName(spark.createDataFrame([(None, "1", "null"), (0, None, "null")], "k long, s string, v string"))
    keys = ["k", "s"]
    for mine, how in ((bloom.anti_join, "left_anti"), (bloom.semi_join, "left_semi")):
        got, want = mine(batch, target, keys), batch.join(target, keys, how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    new, asked = bloom.split_by_filter(batch, target, keys)
    assert new.count() + asked.count() == 20_002 and asked.count() < 2300 and asked.join(target, keys, "left_semi").count() == 2000
    assert bloom.split_by_filter(batch, target, keys, 10**9) is None
    assert bloom.anti_join(batch, target.limit(0), keys).count() == 20_002 and bloom.semi_join(batch, target.limit(0), keys).count() == 0


def shuffled_bytes(df):
    """Bytes that the exchanges of a query wrote."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStage" in kind:
            return walk(node.plan())
        metric = node.metrics().get("shuffleBytesWritten")
        own = metric.get().value() if metric.isDefined() else 0
        return own + sum(walk(node.children().apply(k)) for k in range(node.children().size()))

    return walk(execution.executedPlan())


def test_bloom_joins_shuffle_fewer_bytes(spark, tmp_path):
    """A batch of which most keys are new, against a target that is too large to be broadcast."""
    wide = F.concat_ws("-", *[F.sha2(F.concat(F.col("k").cast("string"), F.lit(str(n))), 256) for n in range(4)]).alias("v")
    spark.range(0, 30_000).select(F.col("id").alias("k")).write.parquet(str(tmp_path / "target"))
    spark.range(29_000, 60_000).select(F.col("id").alias("k")).select("k", wide).repartition(4).write.parquet(str(tmp_path / "batch"))
    target, batch = spark.read.parquet(str(tmp_path / "target")), spark.read.parquet(str(tmp_path / "batch"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filtered, plain = bloom.anti_join(batch, target, ["k"], 30_000), batch.join(target, ["k"], "left_anti")
        assert filtered.count() == plain.count() == 30_000
        assert shuffled_bytes(filtered) < shuffled_bytes(plain) / 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pages_read_the_ranges_they_lie_in(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(f"S{k}", None if k % 9 == 0 else float(rnd.randint(0, 30))) for k in range(400)]
    df = spark.createDataFrame(rows, "symbol string, x double")
    order = [F.desc_nulls_last("x"), F.asc("symbol")]
    index = paging.PageIndex.build(df, order, str(tmp_path / "p"), 8)
    assert index.total == 400 and len([n for n in index.counts if n]) > 4
    want = [tuple(r) for r in df.orderBy(*order).collect()]
    for number, size in ((1, 10), (7, 30), (14, 30), (40, 10), (99, 150), (0, 10)):
        k = min(max(number, 1), -(-400 // size))
        assert [tuple(r) for r in index.page(number, size).collect()] == want[(k - 1) * size : k * size]
    told = plan(index.page(3, 10)).split("PartitionFilters: [")[1].split("]")[0]
    assert "__range" in told and "= 0" in told  # rows 20 to 29 lie in the first range
    got, last = [], None
    while found := [tuple(r) for r in paging.after(df, "x", last, 70).collect()]:
        got, last = got + found, (found[-1][1], found[-1][0])
    assert got == want
    assert paging.PageIndex.build(df.limit(0), order, str(tmp_path / "none"), 4).page(1, 5).count() == 0


def test_windows_over_a_bucketed_table_need_no_exchange(spark, tmp_path):
    rows, told = sessions(300), [("A", START + dt.timedelta(days=200), 0.5)]
    table = bucketed_table(spark.createDataFrame(rows, DAILY), "barline_daily_test", str(tmp_path / "b"), "symbol", 4, ("symbol", "date"))
    spark.createDataFrame(told, SPLITS).write.parquet(str(tmp_path / "splits"))
    out = facts.adjusted_daily_fact(table, spark.read.parquet(str(tmp_path / "splits")))
    bars = [x for x in plan(out).splitlines() if "Exchange hashpartitioning(symbol" in x]
    assert len(bars) <= 1 and "SelectedBucketsCount: 4 out of 4" in plan(out)  # the one that may be is of the splits
    assert sorted(map(str, out.collect())) == sorted(map(str, full(spark, rows, told).collect()))
    assert len(list((tmp_path / "b").glob("*.parquet"))) <= 4
    spark.sql("DROP TABLE barline_daily_test")
