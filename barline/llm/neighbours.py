"""Approximate nearest neighbours by an inverted multi-index (operator 13).

Vectors are cut into two halves, and each half has its own ``k`` centroids, so k + k centroids make k * k
cells.  A query orders the centroids of each half by distance and walks over pairs of them in order of the
summed distance, with a heap that holds the next pairs only, until it has passed as many entries as needed.
The entries of those cells are ranked anew by their exact distance.

Centroids are fitted on a sample of ``SAMPLE`` distinct vectors, chosen by hash; every row is indexed.  How many
entries are needed is found on the same sample: with some of its vectors as queries, the share of entries
that a walk passes until it has met ``TARGET`` of all true neighbours.  In a larger table true neighbours are
nearer than in its sample, so the share is more than enough there.

Equal vectors are one entry with its smallest ids, as many as a result can have: a group of copies costs one
entry, whatever its size, and equal queries are one query.  Entries are dealt by their first centroid, in
blocks of ``ENTRIES``; a query goes once to each block of the centroids that it visits, with the second
centroids as a bitmap, and streams through it.

Defined results: vectors that are null or zero, hold null or what is not finite, or have another length than
most, take no part, nor do rows without vec_id; rows that repeat vec_id and vector count once; vectors of one
vec_id are candidates each; with fewer candidates than asked for all are returned; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window as W, functions as F

from .shared import bounded_batches, cut

NEAREST, EVERY = 10, 100
#: Distinct vectors that centroids are fitted on, queries among them, share of true neighbours to meet.
SAMPLE, TRIALS, TARGET = 20_000, 300, 0.96
#: Entries of a cell on average, at least, while there are fewer than MOST_CENTROIDS for a half.
PER_CELL, MOST_CENTROIDS = 12, 256
#: Entries of a block, queries that are compared with it at once. Any choice is right.
ENTRIES, QUERIES = 32_768, 128
_ROW = "region int, salt int, kind int, q long, second int, v array<double>, ids array<long>, mask binary"
_FOUND = "q long, vec_id long, score double"


def matrix(col: pa.Array) -> np.ndarray:
    """A list column of equally long vectors."""
    return np.asarray(col.flatten()).reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def scale_of(x: np.ndarray) -> float:
    """What vectors are divided by so that squares neither overflow nor vanish; 1 for common ones."""
    most = float(np.abs(x).max(initial=0))
    return most if most > 1e100 or 0 < most < 1e-100 else 1.0


def centroids(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from spread-out points; a centroid that loses all its points keeps its place."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(13)
    out = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        own = distances(points, out).argmin(1)
        count = np.bincount(own, minlength=len(out))
        total = np.stack([np.bincount(own, points[:, d], len(out)) for d in range(points.shape[1])], 1)
        out[count > 0] = total[count > 0] / count[count > 0, None]
    return out


class MultiIndex:
    """Centroids of both halves."""

    def __init__(self, sample: np.ndarray, k: int):
        self.cut = max(sample.shape[1] // 2, 1)
        self.scale = scale_of(sample)
        sample = sample / self.scale
        self.halves = centroids(sample[:, : self.cut], k), centroids(sample[:, self.cut :], k)
        self.shape = len(self.halves[0]), len(self.halves[1])

    def apart(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the centroids of either half; a vector of one component has one half."""
        x = x / self.scale
        return distances(x[:, : self.cut], self.halves[0]), distances(x[:, self.cut :], self.halves[1])

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = self.apart(x)
        return first.argmin(1), second.argmin(1)

    def needed(self, sample: np.ndarray, trials: int, nearest: int, target: float) -> float:
        """Share of all entries that walks pass until they have met this share of the true neighbours."""
        first, second = self.cells(sample)
        cell = first * self.shape[1] + second
        count = np.bincount(cell, minlength=self.shape[0] * self.shape[1])
        scaled, met = sample / self.scale, []
        for at in range(0, min(trials, len(sample)), 50):
            some = slice(at, min(at + 50, trials, len(sample)))
            true = distances(scaled[some], scaled)
            true[np.arange(len(true)), np.arange(some.start, some.stop)] = np.inf
            n = min(nearest, len(sample) - 1)
            true = np.argpartition(true, n - 1, 1)[:, :n] if n else np.zeros((len(true), 0), np.int64)
            a, b = self.apart(sample[some])
            for k, near in enumerate(true):
                order = np.argsort((a[k][:, None] + b[k][None, :]).ravel(), kind="stable")
                passed = np.empty(len(order), np.int64)
                passed[order] = np.cumsum(count[order])
                met.append(passed[cell[near]])
        met = np.concatenate(met) if met else np.zeros(0)
        return float(np.quantile(met, target, method="higher")) / len(sample) if len(met) else 1.0


def walk(first: np.ndarray, second: np.ndarray, count: np.ndarray, needed: float) -> list[tuple[int, int]]:
    """Pairs of centroids in order of summed distance, until the cells passed hold so many entries."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    rows, columns = rows.tolist(), columns.tolist()
    held, heap, out = 0, [(a[0] + b[0], 0, 0)], []
    while heap and held < needed:
        _, i, j = heapq.heappop(heap)
        n = count[rows[i]][columns[j]]
        if n:
            out.append((rows[i], columns[j]))
            held += n
        # (i, j) is reached from (i, j - 1), or, at the start of a row, from the row before: each pair once.
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


class Block:
    """Entries of a region, by second centroid."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).combine_chunks()
        rows = rows.take(pa.array(np.argsort(np.asarray(rows.column("second")), kind="stable")))
        self.second = np.asarray(rows.column("second"))
        self.x = matrix(rows.column("v").combine_chunks())
        ids = rows.column("ids").combine_chunks()
        self.sizes = np.asarray(pa.compute.list_value_length(ids)).astype(np.int64)
        self.ids, self.first = np.asarray(ids.flatten()), np.cumsum(self.sizes) - self.sizes

    def nearest(self, q: np.ndarray, v: np.ndarray, visits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(q, vec_id, distance) of the n nearest of each query, by distance and vec_id."""
        entries = np.flatnonzero(visits.any(0)[self.second])
        if not len(entries):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        x, scale = self.x[entries], max(scale_of(self.x), scale_of(v))
        near, far = v / scale, x / scale
        apart = distances(near, far)
        apart[~visits[:, self.second[entries]]] = np.inf
        few = min(n, len(entries))
        bound = np.partition(apart, few - 1, 1)[:, few - 1]
        # Products round: what may be as near as the last is compared exactly.
        bound = bound + 1e-9 * ((near * near).sum(1) + (far * far).sum(1).max())
        row, column = np.nonzero((apart <= bound[:, None]) & np.isfinite(apart))
        gap = near[row] - far[column]
        score = np.sqrt((gap * gap).sum(1)) * scale
        size = self.sizes[entries[column]]
        nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ids = self.ids[np.repeat(self.first[entries[column]], size) + nth]
        row, score = np.repeat(row, size), np.repeat(score, size)
        by = np.lexsort((ids, score, row))
        row, score, ids = row[by], score[by], ids[by]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < n
        return q[row[kept]], ids[kept], score[kept]


def _search(shape: tuple[int, int], n: int):
    """Rows come ordered by region and salt, entries before queries. A block of entries is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            region, salt, kind = (np.asarray(batch.column(c)) for c in ("region", "salt", "kind"))
            change = (np.diff(region) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)
            cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if key != (region[a], salt[a]):
                    key, parts, block = (region[a], salt[a]), [], None
                rows = batch.slice(a, b - a)
                if kind[a] == 0:
                    parts.append(rows)
                    continue
                if not parts:
                    continue
                block = block or Block(parts)
                q, v = np.asarray(rows.column("q")), matrix(rows.column("v"))
                bits = np.stack([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("mask")])
                visits = np.unpackbits(bits, axis=1, count=shape[1]).astype(bool)
                for at in range(0, len(q), QUERIES):
                    some = slice(at, at + QUERIES)
                    found = block.nearest(q[some], v[some], visits[some], n)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["q", "vec_id", "score"])

    return run


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, each once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~odd & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    # Adding 0 makes -0 a 0, so that equal vectors are equal keys.
    same = F.transform("v", lambda x: x + F.lit(0.0)).alias("v")
    return rows.where(F.size("v") == (usual["n"] if usual else 0)).select("vec_id", same).distinct()


def nearest_neighbours(vectors: DataFrame, nearest: int = NEAREST, every: int = EVERY, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = cut(valid_vectors(vectors))
    n = nearest + 1  # one of them may be the query itself
    nth = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    entries = cut(rows.withColumn("nth", nth).where(F.col("nth") <= n).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    queries = rows.where(F.col("vec_id") % every == 0)
    distinct = cut(queries.select("v").distinct()).withColumn("q", F.monotonically_increasing_id())
    total = entries.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], empty)
    chosen = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    some = entries.where(chosen <= int((1 << 30) * min(sample / total, 1))).orderBy(chosen, F.col("ids")[0]).select("v").toArrow()
    points = matrix(some.column("v").combine_chunks())
    if not len(points):
        points = matrix(entries.limit(1).select("v").toArrow().column("v").combine_chunks())
    k = int(min(max(round((total / PER_CELL) ** 0.5), 2), MOST_CENTROIDS))
    index = MultiIndex(points, k)
    needed = index.needed(points, TRIALS, nearest, target) * total
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = shared.value.cells(matrix(batch.column("v")))
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("ids"), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))], names=["v", "ids", "region", "second"])

    placed = cut(entries.mapInArrow(place, "v array<double>, ids array<long>, region int, second int"))
    count = np.zeros(index.shape, np.int64)
    for i, j, c in placed.groupBy("region", "second").count().collect():  # k * k rows at most
        count[i, j] = c
    blocks = np.maximum(-(-count.sum(1) // ENTRIES), 1)
    counts = spark.sparkContext.broadcast((count.tolist(), blocks.tolist(), needed))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, salts, most = counts.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                first, second = shared.value.apart(matrix(part.column("v")))
                which, region, salt, masks = [], [], [], []
                for r in range(part.num_rows):
                    visits: dict[int, np.ndarray] = {}
                    for i, j in walk(first[r], second[r], cells, most):
                        visits.setdefault(i, np.zeros(len(second[r]), bool))[j] = True
                    for i, mask in visits.items():
                        bits = np.packbits(mask).tobytes()
                        for s in range(salts[i]):
                            which.append(r)
                            region.append(i)
                            salt.append(s)
                            masks.append(bits)
                took = part.take(pa.array(which, pa.int64()))
                none = len(which)
                yield pa.RecordBatch.from_arrays([
                    pa.array(region, pa.int32()), pa.array(salt, pa.int32()), pa.array([1] * none, pa.int32()), took.column("q"), pa.nulls(none, pa.int32()),
                    took.column("v"), pa.nulls(none, pa.list_(pa.int64())), pa.array(masks, pa.binary()),
                ], names=[x.split()[0] for x in _ROW.split(", ")])

    salts_of = F.array(*[F.lit(int(b)) for b in blocks])
    salted = F.pmod(F.xxhash64("v"), F.element_at(salts_of, F.col("region") + 1)).cast("int")
    held = placed.select("region", salted.alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("q"), "second", "v", "ids", F.lit(None).cast("binary").alias("mask"))
    asked = distinct.mapInArrow(visit, _ROW)
    dealt = held.unionByName(asked).repartition("region", "salt").sortWithinPartitions("region", "salt", "kind")
    found = dealt.mapInArrow(_search(index.shape, n), _FOUND)
    best = F.row_number().over(W.partitionBy("q").orderBy("score", "vec_id"))
    lists = found.withColumn("nth", best).where(F.col("nth") <= n).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    answers = cut(distinct.join(lists, "q").select("v", "near"))
    other = F.filter("near", lambda x: (x["vec_id"] != F.col("query_id")) | (x["score"] != 0))
    each = queries.select(F.col("vec_id").alias("query_id"), "v").join(answers, "v").select("query_id", F.slice(other, 1, nearest).alias("near"))
    told = each.select("query_id", F.posexplode("near").alias("at", "x"))
    return told.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
