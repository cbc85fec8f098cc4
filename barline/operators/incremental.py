"""Incremental refresh of adjusted bars and their metrics: only what a change reaches is derived.

A day that is added, changed or taken away reaches its own row and the metrics of the next ``REACH`` sessions of its
symbol.  A split that is added, changed or taken away reaches all of its symbol's rows before it, as factors
are cumulative, and the metrics of ``REACH`` sessions on.

Large tables are made and refreshed in several commits, so that shuffles and replaced files of all of the table are
never on disk at once.  One that breaks off is repaired by the same refresh again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.storage import ParquetTable, shuffles_removed
from .facts import adjusted_daily_fact
from .metrics import LAGS, RVOL_SESSIONS, daily_metrics
from .rollup import daily_bars
from .splits import adjusted

REACH = max(*LAGS.values(), RVOL_SESSIONS)
#: A table is made from pieces of about so many bytes of bars, but not from more pieces than these.
PIECE_BYTES, PIECES = 64 << 20, 16
#: A refresh replaces partitions of about so many rows at once, but not in more turns than these.
TURN_ROWS, TURNS = 2_000_000, 8


def reached(daily: DataFrame, changed: DataFrame, changed_splits: DataFrame) -> DataFrame:
    """(symbol, date, there, affected) of the sessions that are needed to derive what the changes reach.

    daily has the bars after the change; changed the (symbol, date) that were added, changed or taken away;
    changed_splits the (symbol, execution_date).  A row that is not there any more is affected too.
    """
    upto = changed_splits.groupBy("symbol").agg(F.max("execution_date").alias("upto"))
    touched = changed.select("symbol").union(upto.select("symbol")).distinct()
    there = daily.join(touched, "symbol", "left_semi").select("symbol", "date", F.lit(1).alias("there"))
    seeds = changed.select("symbol", "date", F.lit(1).alias("seed")).distinct()
    both = there.join(seeds, ["symbol", "date"], "full").join(upto, "symbol", "left")
    both = both.select("symbol", "date", F.coalesce("there", F.lit(0)).alias("there"), (F.col("seed").isNotNull() | F.coalesce(F.col("date") < F.col("upto"), F.lit(False))).alias("seed"))
    upto_here = W.partitionBy("symbol").orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    on = W.partitionBy("symbol").orderBy("date").rowsBetween(W.currentRow, W.unboundedFollowing)
    # Sessions are numbered; one that is gone counts as the session after it.
    rows = both.withColumn("n", F.sum("there").over(upto_here))
    rows = rows.withColumn("last", F.max(F.when(F.col("seed"), F.col("n") + 1 - F.col("there"))).over(upto_here))
    rows = rows.withColumn("affected", F.coalesce(F.col("n") - F.col("last") <= REACH, F.lit(False)) & ((F.col("there") == 1) | F.col("seed")))
    rows = rows.withColumn("next", F.min(F.when(F.col("affected") & (F.col("there") == 1), F.col("n"))).over(on))
    return rows.where((F.col("next") - F.col("n") <= REACH) | F.col("affected")).select("symbol", "date", (F.col("there") == 1).alias("there"), "affected")


def affected_facts(daily: DataFrame, splits: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows that the changes reach, derived from the sessions that ``reached`` tells."""
    bars = daily.join(keys.where("there").select("symbol", "date", "affected"), ["symbol", "date"])
    return daily_metrics(adjusted(bars.select(*daily.columns, "affected"), splits)).where("affected").drop("affected")


def create(facts: ParquetTable, minutes: DataFrame, splits: DataFrame) -> None:
    """Makes a table of facts from all minute bars. Large ones are taken in pieces of whole symbols, which do not depend on each other."""
    size = int(minutes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    pieces = min(PIECES, max(1, -(-size // PIECE_BYTES)))
    for k in range(pieces):
        piece = minutes.where(F.pmod(F.xxhash64("symbol"), F.lit(pieces)) == k)
        rows = with_partition(adjusted_daily_fact(daily_bars(piece), splits), facts.partition[0])
        facts.append(rows) if k else facts.create(rows)


def _turns(sizes: dict) -> list[list]:
    """Neighbouring partitions, taken together while they are small. sizes: rows by partition."""
    most = max(TURN_ROWS, -(-sum(sizes.values()) // TURNS))
    turns, rows = [], most
    for value in sorted(sizes):
        if rows + sizes[value] > most:
            turns.append([])
            rows = 0
        turns[-1].append(value)
        rows += sizes[value]
    return turns


def _needed(keys: DataFrame, wanted: Column) -> DataFrame:
    """Of keys that are there, those that the affected ones among wanted are derived from; only these stay affected."""
    w = W.partitionBy("symbol").orderBy("date")
    rows = keys.where("there").withColumn("affected", F.col("affected") & wanted).withColumn("n", F.row_number().over(w))
    rows = rows.withColumn("next", F.min(F.when(F.col("affected"), F.col("n"))).over(w.rowsBetween(W.currentRow, W.unboundedFollowing)))
    return rows.where(F.col("next") - F.col("n") <= REACH).select("symbol", "date", "there", "affected")


def refresh(facts: ParquetTable, daily: DataFrame, splits: DataFrame, changed: DataFrame, changed_splits: DataFrame) -> dict:
    """Replaces the affected rows of a table of facts, partitioned by a column made of date (``partition_of``).

    Partitions without an affected row are neither read nor written.
    """
    part = facts.partition[0]
    old = facts.read()
    spark = old.sparkSession
    keys = with_partition(reached(daily, changed, changed_splits), part).persist()
    try:
        with shuffles_removed(spark):
            # One row a partition: how many rows are affected, and whether one of them is still there.
            told = {r[0]: r for r in keys.where("affected").groupBy(part).agg(F.count("*").alias("rows"), F.max("there").alias("there")).collect()}
            if not told:
                return {"operation": "refresh", "rows": 0, "partitions": []}
            held = {r[0]: r["rows"] for r in old.where(F.col(part).isin(*told)).groupBy(part).agg(F.count("*").alias("rows")).collect()}
        rows = 0
        for parts in _turns({value: told[value]["rows"] + held.get(value, 0) for value in told}):
            here = F.col(part).isin(*parts)
            gone = keys.where(F.col("affected") & here).select("symbol", "date")
            kept = old.where(here).join(gone, ["symbol", "date"], "left_anti").select(*old.columns)
            needed = _needed(keys, here)
            with shuffles_removed(spark):
                first, last = needed.agg(F.min("date"), F.max("date")).first()
                emptied = [v for v in parts if not told[v]["there"] and v in held and kept.where(F.col(part) == F.lit(v)).isEmpty()]
            new = affected_facts(daily.where(F.col("date").between(F.lit(first), F.lit(last))), splits, needed)
            entry = facts.overwrite_partitions(kept.unionByName(with_partition(new, part).select(*old.columns)))
            rows += entry["rows"]
            for value in emptied:
                facts.drop_partition(value)
        return {**entry, "operation": "refresh", "rows": rows, "partitions": sorted(told)}
    finally:
        keys.unpersist()


def with_partition(rows: DataFrame, part: str) -> DataFrame:
    """Adds the partition column of a table of facts: ``date`` itself, ``year`` or ``month``."""
    if part == "date":
        return rows
    return rows.withColumn(part, {"year": F.year("date"), "month": F.trunc("date", "month")}[part])
