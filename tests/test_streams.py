"""Streams over tables that are rewritten, keyed upserts with state, late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barline.operators.dedup import upsert_winner
from barline.sources.storage import ParquetTable
from barline.streaming import lateness, upserts

DAYS = [dt.date(2024, 1, d) for d in range(1, 9)]


def numbered(spark, a, b, day):
    return spark.range(a, b).withColumn("date", F.lit(day))


@pytest.fixture
def table(spark, tmp_path):
    return ParquetTable(spark, str(tmp_path / "t"), ("date",))


def drained(table, tmp_path, reader):
    got = []
    take = lambda batch, n: got.extend(r.id for r in batch.collect())
    q = table.changes(reader).writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / reader)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return sorted(got)


def test_appended_rows_stream_once_and_rewritten_ones_not_again(spark, table, tmp_path):
    table.create(numbered(spark, 0, 5, DAYS[0]))
    table.overwrite_partitions(numbered(spark, 10, 15, DAYS[1]))
    assert drained(table, tmp_path, "a") == [*range(5), *range(10, 15)]  # what is there, rewritten or not
    table.append(numbered(spark, 20, 25, DAYS[0]))
    assert drained(table, tmp_path, "a") == list(range(20, 25))
    table.overwrite_partitions(numbered(spark, 0, 3, DAYS[0]))
    assert drained(table, tmp_path, "a") == []
    table.append(numbered(spark, 30, 32, DAYS[0]))
    assert drained(table, tmp_path, "a") == [30, 31]
    assert drained(table, tmp_path, "b") == [0, 1, 2, *range(10, 15), 30, 31]  # a later reader starts with what is there then
    table.replace(numbered(spark, 90, 92, DAYS[0]))
    assert drained(table, tmp_path, "a") == drained(table, tmp_path, "b") == []


def files(tmp_path, day):
    return len(list((tmp_path / "t" / f"date={day}").glob("*.parquet")))


def test_a_partition_gets_few_files_and_compaction_joins_them(spark, table, tmp_path):
    rows = spark.range(0, 4000).repartition(40).withColumn("date", F.element_at(F.array(*map(F.lit, DAYS)), (F.col("id") % 8 + 1).cast("int")))
    table.create(rows)
    assert sum(files(tmp_path, d) for d in DAYS) <= 12  # 40 tasks, 8 dates
    for k in range(5):
        table.append(numbered(spark, 5000 + k, 5001 + k, DAYS[0]))
    before, other = sorted(r.id for r in table.read().collect()), files(tmp_path, DAYS[1])
    assert drained(table, tmp_path, "r") == before
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.compact()["first"] == str(DAYS[0]) and files(tmp_path, DAYS[0]) == 1 and files(tmp_path, DAYS[1]) == other
    assert sorted(r.id for r in table.read().collect()) == before and table.read().schema["date"].dataType.simpleString() == "date"
    assert table.compact()["rows"] == 0 and drained(table, tmp_path, "r") == []
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size


EVENT = "k string, n int, a string, b double, at timestamp"


def stored(spark, rows, folder, parts):
    """Rows in files that a stream takes one by one."""
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], EVENT).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", "1").parquet(folder)


def events(n=120, seed=4):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 2)
    return [(f"k{rnd.randint(0, 9)}", i, rnd.choice(["x", "y", None]), rnd.choice([1.0, 2.0, None]), start + dt.timedelta(minutes=rnd.randint(0, 50))) for i in range(n)]


def upserted(spark, rows, tmp_path, parts=4, late="2 hours"):
    stream = stored(spark, rows, str(tmp_path / "in"), parts)
    changes = upserts.changed_winners(stream, ["k"], [F.unix_micros("at"), F.col("n")], F.col("at"), late)
    q = upserts.write_changes(changes, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(180)
    assert q.exception() is None
    return q, upserts.current_rows(spark, str(tmp_path / "out"), stream.schema, ["k"])


def test_upserts_equal_the_batch_winner_shuffled_and_replayed(spark, tmp_path):
    rows = events()
    sent = rows + rows[:50]
    random.Random(1).shuffle(sent)
    _, got = upserted(spark, sent, tmp_path)
    want = upsert_winner(spark.createDataFrame(rows, EVENT), ["k"], F.struct("at", "n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_batch_writes_what_it_changes_and_state_expires(spark, tmp_path):
    at = dt.datetime(2024, 1, 2)
    batches = [
        [("a", 1, "x", None, at), ("b", 1, "x", 1.0, at)],
        [("a", 2, None, 5.0, at), ("b", 0, "old", 9.0, at)],  # b's event is older, so b does not change
        [("c", 1, "z", 1.0, at + dt.timedelta(hours=9))],  # the watermark passes a and b
        [("d", 1, "z", 1.0, at + dt.timedelta(hours=9))],  # rows are judged by the batch before
        [("e", 1, "z", 1.0, at + dt.timedelta(hours=9)), ("a", 3, "too late", 0.0, at)],
    ]
    rows = [row for k in range(2) for row in (b[k] if k < len(b) else (f"pad{n}", 1, None, None, at + dt.timedelta(hours=9 * (n > 1))) for n, b in enumerate(batches))]
    q, got = upserted(spark, rows, tmp_path, len(batches), "1 hour")
    assert {r.k: (r.n, r.a, r.b) for r in got.collect() if len(r.k) == 1} == {"a": (2, "x", 5.0), "b": (1, "x", 1.0), **{k: (1, "z", 1.0) for k in "cde"}}
    written = {(r.batch_id, r.k) for r in spark.read.parquet(str(tmp_path / "out")).collect() if len(r.k) == 1}
    assert written == {(0, "a"), (0, "b"), (1, "a"), (2, "c"), (3, "d"), (4, "e")}
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert totals[-1] == len({r[0] for r in rows} - {"a", "b"})  # of these two nothing is left


def test_late_rows_are_kept_aside_and_state_falls(spark, tmp_path):
    at = dt.datetime(2024, 1, 2)
    hour = lambda h: at + dt.timedelta(hours=h)
    batches = [
        [("a", 1, "x", None, hour(0)), ("b", 2, "x", None, hour(1))],
        [("a", 3, "again", None, hour(0)), ("c", 4, "x", None, hour(10))],
        [("h", 5, "x", None, hour(8)), ("e", 6, "x", None, hour(9.5))],  # judged by the watermark of the batch before
        [("c", 7, "again", None, hour(10)), ("f", 8, "late", None, hour(9))],  # 9 hours is the watermark here
        [("g", 9, "x", None, hour(30)), ("d", 10, "late", None, hour(8))],
        [("g", 11, "again", None, hour(30)), ("i", 12, "x", None, hour(31))],
    ]
    rows = [b[k] for k in range(2) for b in batches]
    stream = stored(spark, rows, str(tmp_path / "in"), len(batches))
    q = lateness.deduplicated_stream(stream, ["k"], "at", dt.timedelta(hours=1), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(180)
    assert q.exception() is None
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    kept, late = {r.k: r.n for r in read("kept").collect()}, {(r.k, r.n) for r in read("late").collect()}
    assert late == {("f", 8), ("d", 10)} and set(kept) == set("abceghi") and kept["a"] == 1 and kept["c"] == 4
    counts = {r.batch_id: (r.rows, r.late) for r in spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out" / "counts")).collect() if r.rows}
    assert counts == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (2, 1), 4: (2, 1), 5: (2, 0)}
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress)
    assert dropped == 2
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert totals[-1] < max(totals)


def test_a_replayed_batch_is_not_appended_again(spark, table):
    table.append(numbered(spark, 0, 5, DAYS[0]), token="q:0")
    assert table.append(numbered(spark, 0, 5, DAYS[0]), token="q:0")["rows"] == 0 and table.read().count() == 5
    table.append(numbered(spark, 5, 6, DAYS[0]), token="q:1")
    table.append(numbered(spark, 6, 7, DAYS[0]))
    assert table.read().count() == 7
