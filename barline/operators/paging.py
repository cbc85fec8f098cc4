"""Pages of a sorted table that read only where they lie."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class PageIndex:
    """A table written in ranges of its order, with the rows of each range; a page reads the ranges it lies in."""

    rows: DataFrame
    order: list[Column]
    counts: list[int]

    @staticmethod
    def build(rows: DataFrame, order: list[Column], path: str, ranges: int) -> PageIndex:
        """order must be total, or rows that tie may move between pages. Ranges come from a sample; the number of
        rows of each is counted, a number for each range."""
        dealt = rows.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())
        dealt.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("__range").parquet(path)
        written = rows.sparkSession.read.schema(dealt.schema).parquet(path)
        counts = {r[0]: r[1] for r in written.groupBy("__range").count().collect()}
        return PageIndex(written, order, [counts.get(k, 0) for k in range(max(counts, default=-1) + 1)])

    @property
    def total(self) -> int:
        return sum(self.counts)

    def page(self, number: int, size: int) -> DataFrame:
        """Page number, from 1; a number that is out of range gives the first or the last page."""
        number = min(max(number, 1), max(-(-self.total // size), 1))
        first, last = (number - 1) * size, number * size
        start, wanted, skip = 0, [], None
        for k, n in enumerate(self.counts):
            if n and start < last and start + n > first:
                wanted.append(k)
                skip = first - start if skip is None else skip
            start += n
        found = self.rows.where(F.col("__range").isin(wanted)).orderBy(*self.order)
        return found.offset(skip or 0).limit(size).drop("__range")


def after(rows: DataFrame, key: str, last: object | None, size: int, unique: str = "symbol") -> DataFrame:
    """The ``size`` rows that follow a row in the order of key, highest first and nulls last, then of ``unique``: last is
    that row's (key, unique), None for the first page.  Nothing is sorted that a page before had."""
    if last is not None:
        value, name = last
        later = F.col(unique) > F.lit(name)
        rows = rows.where(F.col(key).isNull() & later) if value is None else rows.where((F.col(key) < F.lit(value)) | (F.col(key) == F.lit(value)) & later | F.col(key).isNull())
    return rows.orderBy(F.desc_nulls_last(key), unique).limit(size)
