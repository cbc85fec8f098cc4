"""Starting, watching, draining and stopping of streaming queries."""

from __future__ import annotations

import datetime as dt
import os
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.calendar import market_now, poll_seconds, should_stop_streaming, shutdown_time
from ..schemas import DRAIN_METRICS
from ..sources.storage import ParquetTable

MAIN_TRIGGER, DEAD_LETTER_TRIGGER = "5 seconds", "30 seconds"
DRAIN_SECONDS, SETTLE_SECONDS = 120, 30


def make_folders(root: str, names: Sequence[str]) -> dict[str, tuple[str, str]]:
    """(table, checkpoint) folders of each query; no two share a checkpoint. Local paths are created, on
    object stores folders need not be."""
    out = {n: (f"{root}/{n}", f"{root}/_checkpoints/{n}") for n in names}
    if "://" not in root:
        for pair in out.values():
            for p in pair:
                os.makedirs(p, exist_ok=True)
    return out


def append_stream(df: DataFrame, path: str, checkpoint: str, trigger: str | None = MAIN_TRIGGER, partition: Sequence[str] = ("date",), name: str | None = None) -> StreamingQuery:
    """An appending query. Without a trigger it takes what is there and ends."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return (writer.partitionBy(*partition) if partition else writer).format("parquet").start()


def start_writers(good: DataFrame, dead: DataFrame, folders: Mapping[str, tuple[str, str]], triggers: tuple[str | None, str | None] = (MAIN_TRIGGER, DEAD_LETTER_TRIGGER)) -> tuple[StreamingQuery, StreamingQuery]:
    """Two queries over one parsed source: bars, and dead letters at a slower pace."""
    return (
        append_stream(good, *folders["streaming"], triggers[0]),
        append_stream(dead, *folders["streaming_quarantine"], triggers[1], partition=()),
    )


def upsert_stream(rows: DataFrame, events: ParquetTable, target: ParquetTable, winner: Callable[[DataFrame], DataFrame], checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """A keyed upsert as a stream: each batch is appended to its events, and the partitions it touches are
    derived anew. A batch that is replayed is not appended again. ``upserts`` has one whose batches write what they
    change only."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            events.append(batch, token=f"{checkpoint}:{batch_id}")
            target.upsert(events, batch, winner)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def caught_up(progress: Mapping | None) -> bool:
    """Whether the last batch had no rows; without progress nothing is known, so no."""
    return bool(progress) and progress.get("numInputRows", -1) == 0


def check_alive(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name or q.id} failed: {q.exception()}")


def watch_startup(queries: Sequence[StreamingQuery], polls: int = 6, every_s: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> list[Mapping | None]:
    """Looks at the queries some times after the start and raises as soon as one has failed."""
    for _ in range(polls):
        check_alive(queries)
        sleep(every_s)
    check_alive(queries)
    return [q.lastProgress for q in queries]


def run_until_close(queries: Sequence[StreamingQuery], now: Callable[[], dt.datetime] = market_now, sleep: Callable[[float], None] = time.sleep) -> None:
    """Waits for the session's end, looking more often the nearer it is."""
    while not should_stop_streaming(now()):
        check_alive(queries)
        sleep(poll_seconds((shutdown_time(now()) - now()).total_seconds()))


@dataclass(frozen=True)
class Drained:
    status: str  # clean, timeout or error
    residual_rows: int


def drain(query: StreamingQuery, seconds: float = DRAIN_SECONDS, settle_s: float = SETTLE_SECONDS, sleep: Callable[[float], None] = time.sleep) -> Drained:
    """Processes what has arrived, for some time at most; what is left is taken next time."""
    failed: list[BaseException] = []

    def work() -> None:
        try:
            query.processAllAvailable()
        except Exception as e:  # told below
            failed.append(e)

    worker = threading.Thread(target=work, daemon=True)
    worker.start()
    worker.join(seconds)
    status = "error" if failed else "timeout" if worker.is_alive() else "clean"
    sleep(settle_s)
    return Drained(status, int((query.lastProgress or {}).get("numInputRows", 0)))


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()


def log_drain(spark: SparkSession, table: ParquetTable, pipeline: str, drained: Drained) -> None:
    row = (pipeline, drained.status, drained.residual_rows, dt.datetime.now(dt.timezone.utc))
    table.append(spark.createDataFrame([row], DRAIN_METRICS))
