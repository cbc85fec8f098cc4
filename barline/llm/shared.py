"""Session helpers: storage in the shared folder, sizes of inputs, connected components."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Catalyst says 2**63 - 1 for what it does not know, and products of it for joins.
UNKNOWN = 1 << 58
#: Rows and bytes of text that go to a Python worker at once; a longer text goes alone.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def _number(setting: str) -> int:
    """A setting in rows or bytes; one in another unit counts as none."""
    found = re.fullmatch(r"(\d+)b?", setting)
    return int(found[1]) if found else 0


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches of whole texts small. Spark has these bounds as settings of the session only;
    smaller ones of the session stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not 0 < _number(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, a folder of our own on
    one machine, as in tests, and an error on a cluster, whose machines don't share such a folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return named or os.path.join(tempfile.gettempdir(), "checkpoints")


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def use_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark))


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bytes_of(df: DataFrame) -> int:
    """Catalyst's estimate of the size of df; where it has none, as for rows that are not from files, the
    bytes of the texts are summed."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size <= UNKNOWN:
        return size
    return int(df.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0)


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of the graph with these edges; component is the smallest node reachable.

    Each round sends every node the smallest label among its neighbours and then jumps to the label
    of its label; rounds end when no label changes.  A label thus comes from twice as far in each
    round along a path on which labels fall; there is no bound below the length of the longest path
    for others.  All state stays in DataFrames.  Both sides of each join come from a shuffle of their own,
    so adaptive execution can split what a node with many edges or a label with many nodes brings to
    one partition.  Without edges the result is empty.
    """
    both = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    both = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = cut(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = hooked.select(F.col("node").alias("up"), F.col("label").alias("top"))
        moved = hooked.join(up, hooked.label == up.up, "left").select("node", "old", F.least("label", F.coalesce("top", "label")).alias("label"))
        moved = cut(moved)
        done = moved.where("label <> old").isEmpty()
        labels = moved.select("node", "label")
        if done:
            return labels.select("node", F.col("label").alias("component"))


def item_blocks(items: DataFrame, block_bytes: int) -> tuple[int, Iterator[list[tuple[object, str | None]]]]:
    """How many blocks the distinct (item_id, text) make, and the blocks, each collected when it is asked for."""
    rows = items.select("item_id", "text").distinct()
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return blocks, ([(r[0], r[1]) for r in (rows.where(key == b) if blocks > 1 else rows).collect()] for b in range(blocks))
