"""Keyed upserts with state: each batch yields the keys whose winner it changes, and nothing else.

The winner of a key is what ``dedup.upsert_winner`` makes of all its events: each column has its latest value
that is not null, by a sequence.  The state of a key has its values and the sequence of each, so the work of a
batch follows its events and not the size of the table; order and replays of events do not matter.  A timer ends
the state of a key when the watermark has passed its latest event by ``keep``: rows that could still change it are
late by then.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class LatestValues(StatefulProcessor):
    """The winner of a key, column by column."""

    def __init__(self, keys: Sequence[str], shape: T.StructType, parts: int, keep_ms: int):
        self.keys, self.shape, self.parts, self.keep_ms = tuple(keys), shape, parts, keep_ms
        self.rest = [f for f in shape if f.name not in keys]

    def init(self, handle: StatefulProcessorHandle) -> None:
        state = T.StructType([T.StructField("until", T.LongType())])
        for k, f in enumerate(self.rest):
            state.add(f"v{k}", f.dataType).add(f"s{k}", T.ArrayType(T.LongType()))
        self.handle, self.state = handle, handle.getValueState("winner", state)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.state.get() if self.state.exists() else None
        until = old[0] if old else -(2**63)
        before = [old[1 + 2 * k] if old else None for k in range(len(self.rest))]
        values, told = list(before), [old[2 + 2 * k] if old else None for k in range(len(self.rest))]
        told, last = [None if t is None else list(t) for t in told], until
        for row in rows:
            sequence = [row[f"__s{k}"] for k in range(self.parts)]
            last = max(last, row["__at"])
            for k, f in enumerate(self.rest):
                if row[f.name] is not None and (told[k] is None or sequence > told[k]):
                    values[k], told[k] = row[f.name], sequence
        if last > until:
            self.handle.registerTimer(last + self.keep_ms)
        self.state.update((last, *[x for pair in zip(values, told, strict=True) for x in pair]))
        if old is None or values != before:
            own = dict(zip(self.keys, key, strict=True)) | {f.name: v for f, v in zip(self.rest, values, strict=True)}
            yield Row(**{f.name: own[f.name] for f in self.shape})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists() and self.state.get()[0] + self.keep_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def changed_winners(rows: DataFrame, keys: Sequence[str], sequence: Sequence[Column], at: Column, lateness: str, keep: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """The stream of winners that change. sequence: numbers that are compared in order and are never null; at: event time.

    Rows later than the watermark allows are dropped; ``lateness.deduplicated_stream`` shows how they are kept aside.
    """
    shape, n = rows.schema, len(sequence)
    told = rows.select("*", *[s.cast("long").alias(f"__s{k}") for k, s in enumerate(sequence)], at.alias("__time")).withWatermark("__time", lateness)
    told = told.withColumn("__at", F.unix_millis("__time"))
    return told.groupBy(*keys).transformWithState(LatestValues(keys, shape, n, int(keep.total_seconds() * 1000)), shape, "Update", "EventTime")


def write_changes(changes: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Writes the changes of each batch to a partition of its own; a batch that is replayed replaces its own."""
    spark = changes.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKS)  # state with timers needs it; a query keeps what held when it started
    try:
        writer = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def current_rows(spark: SparkSession, path: str, shape: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last change of each key: the table that the upserts leave."""
    rest = [f.name for f in shape if f.name not in keys]
    log = spark.read.schema(T.StructType([*shape, T.StructField("batch_id", T.LongType())])).parquet(path)
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__row"))
    return last.select(*keys, "__row.*").select(*shape.names)
