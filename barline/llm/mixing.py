"""Mixing sources to target weights by systematic sampling (operator 3), in DataFrame functions only.

Each source gets a target: its weight's share of all words, but at most ``max_repeats`` times the words
it has; what is cut off goes to the others by weight until no target is above that.  A document of a
source is expected ``target / source size`` times.  These expectations are summed along the source,
one offset between 0 and 1 is added, and a document is emitted once for each integer that its sum
crosses.  Documents run in order of size, so the words taken differ from the target by about the size
of one document.

A source may hold any share of the rows, so the running sum has two levels: documents are range
partitioned and sorted by (source, size, doc_id, what else is kept), the rows that each partition has
of each source are counted, and the counts are summed along each source.  Equal rows may fall into
different partitions, so no group is too large for one.  As a document's expectation is the same all
through a source, the running sum is a running count times it, which needs no floating point sum that
could depend on the order of rows.

Defined results: a null text has size 0; null is a source of its own, after all others; a source
without words has target 0; a null doc_id ranks first; equal rows are ranked one after the other, and
which of them comes first shows nowhere; an empty table gives an empty result; columns of the input
with other names are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .shared import cut

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
_WORD = r"[^\x20\x09-\x0D]"
_GAP = r"[\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in text: each word and the gaps around it become one letter."""
    letters = F.regexp_replace(text, f"{_GAP}*+{_WORD}++{_GAP}*+", "x")
    return F.when(text.rlike(_WORD), F.length(letters)).otherwise(0).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, expected) of each source of sizes (source, size).

    With the caps filled in order of cap / weight, the level that the rest would share rises as long as
    the next cap lies below it and falls afterwards; its highest value is the level that holds.  There
    is one row for each source here, so these windows are as long as the list of sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    turn = F.row_number().over(W.orderBy(order)) - 1
    per = per.withColumn("weight", F.array(*map(F.lit, map(float, weights)))[turn % len(weights)])
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), order)
    filled = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn("level", (F.sum("source_size").over(every) - filled) / rest)
    per = per.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.max("level").over(every)))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("source", "source_size", "target", expected.alias("expected"))


def offset(source: Column, seed: int) -> Column:
    """One number from 0 to below 1 for each source, the same in every run."""
    named = F.concat_ws("/", F.lit(str(seed)), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mixed(documents: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = 7, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """keep, source, size, source_size, target, copies and taken of each document."""
    # The texts are counted once; what follows reads these few columns from the shared folder.
    keep = [c for c in keep if c != "source"]
    sizes = cut(documents.select(*keep, "source", word_count(F.col("text")).alias("size")))
    per = targets(sizes, weights, max_repeats).withColumnRenamed("source", "p_source")
    order = [F.col("source").asc_nulls_last(), F.col("size"), *(F.col(c).asc_nulls_first() for c in keep), F.col("mix_tie")]
    ranges = sizes.withColumn("mix_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = ranges.select(*keep, "source", "size", F.spark_partition_id().alias("mix_part"), F.monotonically_increasing_id().alias("mix_place"))
    placed = cut(ranges)

    parts = placed.groupBy("source", "mix_part").agg(F.count(F.lit(1)).alias("rows"), F.min("mix_place").alias("first"))
    along = W.partitionBy("source").orderBy("mix_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("rows").over(along), F.lit(0)) - F.col("first") + 1)
    parts = parts.join(per, F.col("source").eqNullSafe(F.col("p_source")))
    parts = parts.select(F.col("source").alias("b_source"), F.col("mix_part").alias("b_part"), "before", "source_size", "target", "expected")

    same = (F.col("mix_part") == F.col("b_part")) & F.col("source").eqNullSafe(F.col("b_source"))
    at = (F.col("before") + F.col("mix_place")).cast("double")
    u = offset(F.col("source"), seed)
    copies = F.floor(at * F.col("expected") + u) - F.floor((at - 1) * F.col("expected") + u)
    return placed.join(parts, same).select(*keep, "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_documents(documents: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS, seed: int = 7) -> DataFrame:
    """The documents of the mix: each row as often as the mix takes it."""
    row = F.struct(*documents.columns).alias("mix_row")
    rows = documents.select("doc_id", "text", "source", F.xxhash64("doc_id", "text", "source").alias("mix_key"), row)
    plan = mixed(rows, weights, max_repeats, seed, keep=("doc_id", "mix_key"))
    # Rows that repeat doc_id, text and source share a key; they share out the copies of all of them.
    plan = plan.groupBy("mix_key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    rows = rows.select("mix_key", "mix_row")
    nth = F.row_number().over(W.partitionBy("mix_key").orderBy(F.col("mix_row.doc_id"))) - 1
    repeated = rows.join(plan.where("rows > 1"), "mix_key").withColumn("nth", nth)
    repeated = repeated.withColumn("copies", F.expr("copies div rows + if(nth < copies % rows, 1, 0)")).drop("nth")
    emitted = rows.join(plan.where("rows = 1"), "mix_key").unionByName(repeated).where("copies > 0")
    emitted = emitted.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return emitted.select(*[F.col("mix_row")[c].alias(c) for c in documents.columns])


ORACLE_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap,
         (sum(source_size) OVER () - coalesce(sum(source_size * 3.0::DOUBLE) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per),
goals AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target,
                 CAST(('0x' || substr(md5('7/' || coalesce('s' || source, 'null')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
          FROM levels),
ranked AS (
  SELECT s.doc_id, s.source, CAST(s.size AS BIGINT) AS size, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS e,
         CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS DOUBLE) AS nth
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(nth * e + u) - floor((nth - 1) * e + u)) * size AS BIGINT) AS taken
FROM ranked
"""
