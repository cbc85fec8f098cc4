"""Parquet tables with the write modes of ingestion, and a commit log of what was written."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


#: How files of commits that append, and of those that rewrite, begin.
APPEND, REWRITE = "part", "rewrite"
#: Size of a file after compaction.
FILE_BYTES = 128 << 20


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a statement go when it ends, and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def unknown_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str] = ("symbol", "start_timestamp"), day: str = "date") -> DataFrame:
    """Rows of batch whose key target has not. The batch's first date is a scalar, so that only partitions
    from it on are read of target."""
    known = target.where(F.col(day) >= batch.agg(F.min(day)).scalar()).select(*keys)
    return batch.join(known, list(keys), "left_anti")


@dataclass
class ParquetTable:
    """A table in a folder, partitioned by date columns. log holds one small JSON file for each commit."""

    spark: SparkSession
    path: str
    partition: Sequence[str] = ("date",)
    sort: Sequence[str] = ()

    # ---- reading

    def exists(self) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return bool(at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read_or_none(self) -> DataFrame | None:
        try:
            return self.read()
        except AnalysisException:
            return None

    def latest(self, column: str = "date") -> dt.date | None:
        df = self.read_or_none()
        return None if df is None else df.agg(F.max(column)).first()[0]

    # ---- writing

    def _commit(self, df: DataFrame, mode: str, operation: str, partitions: str = "dynamic", rewrites: bool = False, token: str | None = None) -> dict:
        """Writes and logs rows and dates, which are observed on the way: no second pass counts them.

        Rows are rebalanced by partition: small partitions share a task and large ones are split, so a
        partition gets as many files as it has advisory sizes, whatever the number of tasks.  Files of a commit
        that rewrites rows are named after it, so streams can leave them out.
        """
        day = self.partition[0] if self.partition else None
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("rows")] + ([F.min(day).alias("first"), F.max(day).alias("last")] if day else [])
        # Observed above the rebalance: where its shuffle turns out empty, Spark drops all that lies below from
        # the plan, and what was observed there with it.
        rows = df.hint("rebalance", *[F.col(c) for c in self.partition]) if self.partition else df
        rows = rows.observe(seen, *measures)
        if self.sort:
            rows = rows.sortWithinPartitions(*self.partition, *self.sort)
        at = dt.datetime.now(dt.timezone.utc).isoformat()
        name = f"{REWRITE}{re.sub('[^0-9]', '', at)[:20]}" if rewrites else APPEND
        writer = rows.write.mode(mode).option("partitionOverwriteMode", partitions).option("mapreduce.output.basename", name)
        with shuffles_removed(self.spark):
            (writer.partitionBy(*self.partition) if self.partition else writer).parquet(self.path)
        found = seen.get
        entry = {"operation": operation, "rows": found["rows"], "first": str(found.get("first")), "last": str(found.get("last")), "at": at, "files": name, "token": token}
        self.spark.createDataFrame([(entry["at"], json.dumps(entry))], "at string, details string").coalesce(1).write.mode("append").json(self._log)
        return entry

    @property
    def _log(self) -> str:
        return f"{self.path.rstrip('/')}__log"

    def history(self, n: int = 20) -> DataFrame:
        """The last commits: operation, rows, first and last date, time."""
        log = self.spark.read.schema("at string, details string").json(self._log)
        parsed = F.from_json("details", "operation string, rows long, first string, last string")
        return log.orderBy(F.desc("at")).limit(n).select("at", parsed.alias("d")).select("at", "d.*")

    def create(self, df: DataFrame) -> dict:
        return self._commit(df, "errorifexists", "create")

    def append(self, df: DataFrame, token: str | None = None) -> dict:
        """Appends rows. With a token that a commit has had already, as when a batch of a stream is replayed, nothing is done."""
        if token is not None and self._has(token):
            return {"operation": "append", "rows": 0, "token": token}
        return self._commit(df, "append", "append", token=token)

    def _has(self, token: str) -> bool:
        try:
            log = self.spark.read.schema("at string, details string").json(self._log)
        except AnalysisException:
            return False
        return not log.where(F.get_json_object("details", "$.token") == token).isEmpty()

    def replace(self, df: DataFrame) -> dict:
        """The whole table: how a materialised view is recomputed."""
        return self._commit(df, "overwrite", "replace", "static", rewrites=True)

    def overwrite_partitions(self, df: DataFrame) -> dict:
        """Replaces the partitions that df has rows in, and no others: writing again changes nothing."""
        return self._commit(df, "overwrite", "overwrite partitions", rewrites=True)

    def replace_snapshot(self, df: DataFrame, day: dt.date, column: str = "snapshot_date") -> dict:
        """Replaces one snapshot; df must hold that date only."""
        other = df.where(~F.col(column).eqNullSafe(F.lit(day))).limit(1).count()
        if other:
            raise ValueError(f"rows of other dates than {day} in the snapshot")
        return self._commit(df, "overwrite", f"snapshot {day}", rewrites=True)

    def insert_new(self, df: DataFrame, keys: Sequence[str] = ("symbol", "start_timestamp")) -> dict:
        """Appends rows whose key is not there yet; rows that are there are never changed.

        Keys that the batch repeats keep one row, the one ingested last.  Only partitions from the
        batch's first date on are read of the target.
        """
        from ..operators.dedup import latest_ingested

        batch = latest_ingested(df, keys) if "ingestion_timestamp" in df.columns else df.dropDuplicates(list(keys))
        target = self.read_or_none()
        if target is None:
            return self._commit(batch, "append", "insert new (create)")
        if df.isEmpty():
            return {"operation": "insert new", "rows": 0}
        return self._commit(unknown_rows(batch, target, keys, self.partition[0]), "append", "insert new")

    def upsert(self, events: ParquetTable, changed: DataFrame, winner: Callable[[DataFrame], DataFrame]) -> dict:
        """Derives the partitions of changed anew from all their events, and replaces them.

        events must hold the rows of changed already.  As the winner of a key depends on its set of
        events only, neither their order nor a replay matters, and a write that broke off is repaired
        by the next.
        """
        day = self.partition[0]
        days = [r[0] for r in changed.select(day).distinct().collect()]
        if not days:
            return {"operation": "upsert", "rows": 0}
        affected = events.read().where(F.col(day).isin(*days))
        return self._commit(winner(affected), "overwrite", "upsert", rewrites=True)

    def compact(self, file_bytes: int = FILE_BYTES) -> dict:
        """Rewrites the partitions whose files would fit into half as many of ``file_bytes``, and no others.
        Rows stay as they are, and streams do not see them again."""
        if not self.partition:
            raise ValueError("only partitioned tables are compacted")
        folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(self.path)
        sizes = files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
        crowded = [r.folder for r in sizes.where(F.col("n") >= 2 * F.ceil(F.col("bytes") / file_bytes)).where("n > 1").select("folder").collect()]  # one row a partition
        if not crowded:
            return {"operation": "compact", "rows": 0}
        rows = self.spark.read.schema(self.read().schema).option("basePath", self.path).parquet(*crowded)
        key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, str(file_bytes))
        try:
            return self._commit(rows, "overwrite", "compact", rewrites=True)
        finally:
            self.spark.conf.set(key, before)

    def drop_partition(self, value: object) -> None:
        """Removes one partition; to be used for one that has no rows any more."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.partition[0]}={value}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    # ---- streaming

    def changes(self, reader: str, files_per_batch: int | None = None) -> DataFrame:
        """The table as a stream: what it holds when the reader first comes, then the rows that commits append.

        Rows of a commit that rewrites (an overwrite, an upsert, a compaction) are not new and do not come
        again.  Each reader's start is kept beside the commit log, so it is the same after a restart.  Rows that
        are rewritten before the reader comes to them are not streamed: run it more often than rewrites.
        """
        # Names of the rewriting commits whose files the reader starts with.
        started = f"{self._log}_readers"
        known = self._told(started).where(F.col("reader") == reader).select("files")
        if known.isEmpty():
            log = self.spark.read.schema("at string, details string").json(self._log)
            names = log.select(F.get_json_object("details", "$.files").alias("files")).where(F.col("files").startswith(REWRITE)).distinct()
            names = names.agg(F.array_join(F.sort_array(F.collect_set("files")), ",").alias("files"))
            names.select(F.lit(reader).alias("reader"), "files").coalesce(1).write.mode("append").json(started)
            known = self._told(started).where(F.col("reader") == reader).select("files")
        names = known.first()["files"]
        wanted = "{" + ",".join(f"{n}-*.parquet" for n in [APPEND, *filter(None, names.split(","))]) + "}"
        return stream_table(self.spark, self.path, self.read().schema, files_per_batch, pathGlobFilter=wanted, ignoreMissingFiles="true")

    def _told(self, folder: str) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(at)
        return self.spark.read.schema("reader string, files string").json(folder)


def bucketed_table(df: DataFrame, name: str, path: str, by: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """Writes df as a table of one file for each bucket of ``by``: joins, windows and aggregations by it need no shuffle."""
    writer = df.repartition(buckets, by).write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, by)
    (writer.sortBy(*sort) if sort else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def aligned(df: DataFrame, target: T.StructType) -> DataFrame:
    """df in the shape of target: missing columns are typed nulls, others than target's are an error."""
    extra = [c for c in df.columns if c not in target.names]
    if extra:
        raise ValueError(f"columns that the table does not have: {', '.join(extra)}")

    def column(f: T.StructField) -> Column:
        return (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*map(column, target))


def preview(df: DataFrame, partition: Sequence[str] = ("date",)) -> DataFrame:
    """How many rows an append would bring to each partition."""
    return df.groupBy(*partition).agg(F.count(F.lit(1)).alias("rows"))


def guarded_append(table: ParquetTable, df: DataFrame, dry_run: bool = True) -> dict:
    """Appends, or with dry_run only tells how many rows there would be by date."""
    if not dry_run:
        return table.append(df)
    return {"operation": "dry run", "dates": {str(r[0]): r[1] for r in preview(df, table.partition[:1]).orderBy(table.partition[0]).collect()}}


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header; for results that a person reads."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def table_name(*parts: str) -> str:
    """A qualified name for spark.table, each part quoted."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts if p)


def catalog_table(spark: SparkSession, *parts: str) -> DataFrame:
    return spark.table(table_name(*parts))


def path_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder by path in SQL, without a catalog entry."""
    return spark.sql(f"SELECT * FROM parquet.`{path.replace('`', '``')}`")


def stream_table(spark: SparkSession, path: str, shape: T.StructType, files_per_batch: int | None = None, **options: str) -> DataFrame:
    """A Parquet folder as a stream of the files that arrive. A file that replaces others is a new file: for
    tables whose partitions are overwritten there is ``ParquetTable.changes``."""
    reader = spark.readStream.schema(shape).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(path)
