"""Deduplication with bounded state, and late rows kept aside.

Spark drops rows that are later than the watermark allows without a trace.  Here one query has both its input
and what is left after deduplication in each batch, so late rows are told from duplicates, written and counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

COUNTS = "batch_id long, high timestamp, watermark timestamp, rows long, kept long, late long"


def deduplicated_stream(rows: DataFrame, keys: Sequence[str], at: str, lateness: dt.timedelta, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Writes the first row of each key to path/kept, rows at or before the watermark to path/late, and what
    each batch had to path/counts.

    Keys are remembered until the watermark passes their event time by ``lateness`` once more; state is bounded by the
    rows of that time.  Spark judges the rows of a batch by the watermark that the batch before it began with: the
    highest event time of the batches before that one, less ``lateness``.  It is kept with the counts, so a
    batch that is replayed is judged alike and replaces its own rows.  A row without event time is never late and not deduplicated over batches.
    """
    spark, names = rows.sparkSession, rows.columns
    once = rows.withWatermark(at, f"{int(lateness.total_seconds() * 1000)} milliseconds").dropDuplicatesWithinWatermark(list(keys))
    both = rows.select(*names, F.lit(False).alias("__kept")).unionByName(once.select(*names, F.lit(True).alias("__kept")))

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            told = spark.read.schema(COUNTS).option("recursiveFileLookup", "true").parquet(f"{path}/counts") if number > 1 else None
            high = told.where(F.col("batch_id") < number - 1).agg(F.max("high")).first()[0] if number > 1 else None
            mark = None if high is None else high - lateness
            mark = None if mark is None else mark.replace(microsecond=mark.microsecond // 1000 * 1000)
            late = batch.where(~F.col("__kept") & (F.col(at) <= F.lit(mark).cast("timestamp"))).drop("__kept")
            late.write.mode("overwrite").parquet(f"{path}/late/batch_id={number}")
            batch.where("__kept").drop("__kept").write.mode("overwrite").parquet(f"{path}/kept/batch_id={number}")
            seen = batch.agg(F.max(F.when(~F.col("__kept"), F.col(at))), F.count_if(~F.col("__kept")), F.count_if("__kept")).first()
            row = (number, seen[0], mark, seen[1], seen[2], late.count())
            spark.createDataFrame([row], COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/n={number}")
        finally:
            batch.unpersist()

    writer = both.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
