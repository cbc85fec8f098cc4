"""Semi and anti joins behind a Bloom filter: rows that are surely new, or surely unknown, are not shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the filter for each key, bits that a key sets, and the largest filter that is broadcast.
BITS, HASHES, BROADCAST_BYTES = 10, 5, 16 << 20


def _places(keys: Sequence[str], bits: int) -> list[Column]:
    """Double hashing: HASHES places of a key."""
    a, b = (F.pmod(F.xxhash64(F.lit(k), *keys), F.lit(bits)) for k in range(2))
    return [F.pmod(a + b * F.lit(k), F.lit(bits)) for k in range(HASHES)]


def _bit(at: Column) -> Column:
    """The bit of a place in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def key_filter(target: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """One row: the words of the filter, by number. Tasks combine their bits before the shuffle."""
    place = target.select(F.explode(F.array(*_places(keys, bits))).alias("at"))
    words = place.select(F.floor(F.col("at") / 64).cast("int").alias("word"), _bit(F.col("at")).alias("bits"))
    every = target.sparkSession.range(-(-bits // 64)).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    held = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return held.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w")).select(F.transform("w", lambda x: x["bits"]).alias("__words"))


def _may_hold(words: Column, keys: Sequence[str], bits: int) -> Column:
    hit = F.lit(True)
    for at in _places(keys, bits):
        word = F.get(words, F.floor(at / 64).cast("int"))
        hit = hit & (word.bitwiseAND(_bit(at)) != 0)
    return hit


def split_by_filter(batch: DataFrame, target: DataFrame, keys: Sequence[str], n_keys: int | None = None) -> tuple[DataFrame, DataFrame] | None:
    """(rows whose key is surely not in target, rows that need a join); None where the filter would be too large.

    n_keys is about how many keys target has; without it they are counted.
    """
    n = target.count() if n_keys is None else n_keys
    bits = max(64, -(-n * BITS // 64) * 64)
    if bits // 8 > BROADCAST_BYTES:
        return None
    # A scalar in a filter: the filter stays below the join that follows, which would pass a join with one row.
    may = _may_hold(key_filter(target.select(*keys), keys, bits).scalar(), keys, bits)
    return batch.where(~may), batch.where(may)


def anti_join(batch: DataFrame, target: DataFrame, keys: Sequence[str], n_keys: int | None = None) -> DataFrame:
    """Rows of batch whose key target has not; a key with a null is never in it."""
    split = split_by_filter(batch, target, keys, n_keys)
    if split is None:
        return batch.join(target.select(*keys), list(keys), "left_anti")
    return split[0].unionByName(split[1].join(target.select(*keys), list(keys), "left_anti"))


def semi_join(batch: DataFrame, target: DataFrame, keys: Sequence[str], n_keys: int | None = None) -> DataFrame:
    """Rows of batch whose key target has."""
    split = split_by_filter(batch, target, keys, n_keys)
    return (batch if split is None else split[1]).join(target.select(*keys), list(keys), "left_semi")
