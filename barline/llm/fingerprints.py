"""Document fingerprints: invertible Bloom lookup sketches of paragraphs (operator 9).

A paragraph is a line, or a sentence of it; its digest is a hash of its bytes.  A sketch has ``cells``
cells with a count, the sum of digests and the sum of a check of each; a digest goes into three of them.
Sketches of two texts subtract cell by cell: what both have cancels out, and peeling recovers the
digests that differ, from cells that hold one digest only.  If peeling gets stuck, both sketches are
made again with twice the cells.  The likeness of two texts is the share of their distinct paragraphs
that both have, which follows from the sizes and the recovered differences.

``next_document`` pairs each document with the next by doc_id.  Rows are dealt to ranges of doc_id, a
partition each, and the first row of each range is sent to the range before as well, so texts are
shuffled once.  The number of ranges grows with the input.

Defined results: a null text is empty and has no paragraph; two texts without paragraphs are alike (1);
a null doc_id comes first; among rows with one doc_id the order is by text; a single document is its own
next; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from . import textkit as tk
from .shared import bounded_batches, bytes_of

CELLS = 24
HASHES = 3
#: Bytes of input in a range of doc_ids, the most ranges, whose cuts the driver holds (beyond them ranges grow; a
#: task streams its range), and sampled doc_ids for a range. Any choice is right.
RANGE_BYTES, MOST_RANGES, SAMPLES = 32 << 20, 50_000, 8
_U32 = tk.U64(32)
_STOP = tk.byte_class((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))


def paragraphs(piece: tk.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Distinct digests of each document's paragraphs, ascending, and their bounds."""
    data = piece.data
    ends = data == 0x0A
    ends[:-1] |= _STOP[data[:-1]] & (data[1:] == 0x20)
    bounds = np.unique(np.concatenate([np.flatnonzero(ends) + 1, piece.offs]))
    start, end = bounds[:-1], bounds[1:].copy()
    # Blanks around a paragraph don't count.
    blank = tk.SPACE[data]
    filled = np.flatnonzero(~blank)
    low = np.searchsorted(filled, start)
    high = np.searchsorted(filled, end)
    some = high > low
    start, end = filled[low[some]], filled[high[some] - 1] + 1
    doc = np.searchsorted(piece.offs, start, "right") - 1
    keys = tk.span_hash(data, start, end)
    by = np.lexsort((keys, doc))
    keys, doc = keys[by], doc[by]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(piece.n + 1))


def _cells_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """The three cells of each digest, one in each third."""
    third = tk.U64(cells // HASHES)
    salts = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], tk.U64)
    h = tk.mix(keys[:, None] ^ salts[None, :]) >> _U32
    return ((h * third) >> _U32).astype(np.int64) + np.arange(HASHES) * int(third)


def _check(keys: np.ndarray) -> np.ndarray:
    return tk.mix(keys + tk.U64(0x9216D5D98979FB1B)) & tk.U64(0xFFFFFFFF)


class Sketches:
    """Sketches of n documents: count, digest sum and check sum of each cell."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.digest = np.zeros(n * cells, tk.U64)
        self.check = np.zeros(n * cells, tk.U64)

    def add(self, doc: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        at = (doc[:, None] * self.cells + _cells_of(keys, self.cells)).ravel()
        by = np.argsort(at, kind="stable")
        at = at[by]
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
        if not len(head):
            return
        sign = np.broadcast_to(np.asarray(sign, np.int64), len(keys))
        s = np.repeat(sign, HASHES)[by]
        self.count[at[head]] += np.add.reduceat(s, head)
        for total, value in ((self.digest, keys), (self.check, _check(keys))):
            v = np.repeat(value, HASHES)[by] * s.astype(tk.U64)
            total[at[head]] += np.add.reduceat(v, head)

    @staticmethod
    def of(keys: np.ndarray, bounds: np.ndarray, cells: int) -> Sketches:
        out = Sketches(len(bounds) - 1, cells)
        out.add(tk.doc_of(bounds), keys)
        return out

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.cells)
        out.count = self.count - other.count
        out.digest = self.digest - other.digest
        out.check = self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, digest, sign) of all that is recovered, and which documents are recovered whole."""
        docs, keys, signs = [], [], []
        while True:
            pure = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[pure]
            key = np.where(sign > 0, self.digest[pure], tk.U64(0) - self.digest[pure])
            check = np.where(sign > 0, self.check[pure], tk.U64(0) - self.check[pure])
            doc = pure // self.cells
            good = check == _check(key)
            if good.any():
                good &= (_cells_of(key, self.cells) == (pure % self.cells)[:, None]).any(1)
            doc, key, sign = doc[good], key[good], sign[good]
            if not len(doc):
                break
            once = np.unique(np.stack([doc.astype(tk.U64), key], 1), axis=0, return_index=True)[1]
            doc, key, sign = doc[once], key[once], sign[once]
            self.add(doc, key, -sign)
            docs.append(doc)
            keys.append(key)
            signs.append(sign)
        left = ((self.count != 0) | (self.digest != 0) | (self.check != 0)).reshape(self.n, self.cells).any(1)
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, tk.U64), np.zeros(0, np.int64), ~left
        return np.concatenate(docs), np.concatenate(keys), np.concatenate(signs), ~left

    def strings(self, sizes: np.ndarray) -> list[str]:
        """Each document's sketch as text: distinct paragraphs, then counts, digests and checks."""
        body = np.concatenate([
            sizes.astype("<u4").reshape(self.n, 1).view(np.uint8),
            self.count.astype("<u2").reshape(self.n, self.cells).view(np.uint8),
            self.digest.astype("<u8").reshape(self.n, self.cells).view(np.uint8),
            (self.check & tk.U64(0xFFFFFFFF)).astype("<u4").reshape(self.n, self.cells).view(np.uint8),
        ], axis=1)
        return [base64.b64encode(row.tobytes()).decode() for row in body]


def differences(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], cells: int = CELLS) -> tuple[np.ndarray, list[tuple]]:
    """Number of digests that only one of each pair of documents has, and (pair, digest, sign) in parts.

    left and right are (digests, bounds) of equally many documents.
    """
    n = len(left[1]) - 1
    count, parts = np.zeros(n, np.int64), []
    todo = np.arange(n)
    while len(todo):
        some = [_choose(x, todo) for x in (left, right)]
        diff = Sketches.of(*some[0], cells).minus(Sketches.of(*some[1], cells))
        doc, keys, signs, whole = diff.peel()
        keep = whole[doc] if len(doc) else np.zeros(0, bool)
        count[todo] = np.bincount(doc[keep], minlength=len(todo))
        parts.append((todo[doc[keep]], keys[keep], signs[keep]))
        todo, cells = todo[~whole], cells * 2
    return count, parts


def _choose(sets: tuple[np.ndarray, np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, bounds = sets
    size = np.diff(bounds)[docs]
    first = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(bounds[docs], size) + np.arange(int(first[-1])) - np.repeat(first[:-1], size)
    return keys[at], first


def likeness(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], cells: int = CELLS) -> np.ndarray:
    """Share of the distinct paragraphs of each pair that both have; 1 if neither has any."""
    total = np.diff(left[1]) + np.diff(right[1])
    apart, _ = differences(left, right, cells)
    return np.where(total + apart > 0, (total - apart) / np.maximum(total + apart, 1), 1.0)


def range_cuts(ids: DataFrame, parts: int) -> np.ndarray:
    """Up to parts - 1 numbers that cut doc_ids into ranges of about as many rows, from a sample of them by
    hash with SAMPLES numbers for a range, or all if there are few."""
    rows, wanted = ids.count(), max(SAMPLES * parts, 20_000)
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = ids.where(h <= int((1 << 30) * min(wanted / max(rows, 1), 1))).distinct().toPandas()["doc_id"].to_numpy(np.int64)
    some.sort()
    return np.unique(some[np.arange(1, parts) * len(some) // parts]) if len(some) else some


def next_document(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(part, wrapped, doc_id, text) dealt and sorted so that each row but those marked ``wrapped`` has
    the next document in the row after it, in the same task."""
    spark = documents.sparkSession
    bounded_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = min(max(bytes_of(documents) // range_bytes, spark.sparkContext.defaultParallelism), MOST_RANGES)
    known = F.coalesce("doc_id", F.lit(-(2**63)))  # a null doc_id is in the first range, before all others
    cuts = spark.sparkContext.broadcast(range_cuts(docs.where("doc_id is not null").select("doc_id"), parts))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts.value, ids.to_numpy(), "right").astype(np.int32))

    docs = docs.withColumn("part", range_of(known))
    # The least doc_id of each range, null before all; there are as many as there are ranges.
    first = docs.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("lead"))
    first = first.orderBy("part").select("part", F.col("lead.known").alias("known"), F.coalesce("lead.doc_id", F.lit(0)).alias("doc_id")).toPandas()
    lead = spark.sparkContext.broadcast((first["part"].to_numpy(np.int32), first.loc[first["known"], "doc_id"].to_numpy(np.int64)))

    @F.pandas_udf("boolean")
    def leads(ids: pd.Series) -> pd.Series:
        return pd.Series(np.isin(ids.to_numpy(), lead.value[1]))

    @F.pandas_udf("int")
    def before(part: pd.Series) -> pd.Series:
        numbers = lead.value[0]
        return pd.Series(numbers[np.searchsorted(numbers, part.to_numpy()) - 1])  # before the first range is the last

    # Rows that share the least doc_id of their range compete for its first place; the least text leads.
    heads = docs.where(leads(known) | F.col("doc_id").isNull())
    nth = W.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    heads = heads.withColumn("nth", F.row_number().over(nth)).where("nth = 1")
    heads = heads.select(before("part").alias("part"), F.lit(True).alias("wrapped"), "doc_id", "text")
    rows = docs.select("part", F.lit(False).alias("wrapped"), "doc_id", "text").unionByName(heads)
    return rows.repartitionById(parts, "part").sortWithinPartitions("part", "wrapped", F.col("doc_id").asc_nulls_first(), "text")


PRINT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edit(text: str, following: str) -> str:
    """text with its last half of code points replaced by as many of the next document's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_versions(documents: DataFrame, cells: int = CELLS) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness to it and to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = pa.Table.from_batches([batch.slice(at, 1000)])
                if carry is not None:
                    rows = pa.concat_tables([carry, rows])
                carry = rows.slice(rows.num_rows - 1)
                if rows.num_rows > 1:
                    yield from compare(rows.combine_chunks())

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = rows.column("text").to_pylist()
        wrapped = rows.column("wrapped").to_pylist()
        ids = rows.column("doc_id").to_pylist()
        pick = [k for k in range(len(texts) - 1) if not wrapped[k]]
        if not pick:
            return
        edited = [edit(texts[k], texts[k + 1]) for k in pick]
        mine = _digests(texts)
        theirs = _digests(edited)
        own, following = _choose(mine, np.array(pick)), _choose(mine, np.array(pick) + 1)
        cols = [
            pa.array([ids[k] for k in pick], pa.int64()),
            pa.array([len(texts[k]) for k in pick], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(Sketches.of(*own, cells).strings(np.diff(own[1])), pa.string()),
            pa.array(Sketches.of(*theirs, cells).strings(np.diff(theirs[1])), pa.string()),
            pa.array(likeness(own, theirs, cells)),
            pa.array(likeness(own, following, cells)),
        ]
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in PRINT.split(", ")])

    return next_document(documents).mapInArrow(run, PRINT)


def _digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    keys, sizes = [], []
    for piece in tk.pieces(pa.array(texts, pa.large_string())):
        k, bounds = paragraphs(piece)
        keys.append(k)
        sizes.append(np.diff(bounds))
    return np.concatenate(keys), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
