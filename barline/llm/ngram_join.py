"""Exact n-gram Jaccard join in a metric space, and its components (operator 4).

A document is the set of its distinct shingles, and 1 - Jaccard is a metric on sets.  Equal sets are one
point, so a group of copies costs one point whatever its size.

Candidates.  In any one order of all shingles, points at distance 0.2 or less share at least ``l`` of
their first ``n - ceil(0.8 n) + l`` shingles.  With l an eighth of the set, a point of which too few of
these shingles stand in other points too has no links, and is done; passages that documents have in
common do not get them over that bar.  The order is by hash, with shingles that are frequent in some
piece of the corpus last.

Regions.  Candidates that share one of their first ``n - ceil(0.8 n) + 1`` shingles, and whose sizes
allow a link, form a cell around a pivot, the least of them; all cells of a pivot make its region.  A
point may lie in several regions: it is replicated to each pivot that it can be linked through, and two
linked points always have a region in common.

Inside a region the distances of all points to the pivot are taken; those within 0.2 are linked to it.
The others are compared block by block, but only inside the window that the triangle inequality leaves,
|d(x, pivot) - d(y, pivot)| <= 0.2, and only while the window has points that are not connected yet.  A
region yields the links of a spanning forest, never all pairs of a group; components are then merged over
all regions.

A region whose sets have more than ``REGION_SHINGLES`` shingles together is dealt to blocks by a hash of
the set, and each pair of blocks is a task: each link is found where its two blocks meet, and no task
holds more than two blocks.

Numbers of links are exact: all points of a region whose sizes allow a link are compared, block by block,
and a linked pair counts in the region of its smallest common pivot only, as often as there are copies.

Defined results: a text without words, or null, has no shingles and is linked with nothing, its
component is its own doc_id; a copy is a link; repeated rows are copies; a null doc_id is never a component's id unless
all its documents lack one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from . import repeats, textkit as tk
from .shared import components, cut

WORDS = 5
PERCENT = 80
#: How many of the shingles that are frequent in pieces go to the end of the order. Any choice is right.
FREQUENT = 20_000
#: A set's longer prefix has this share of its shingles more, 1 / EXTRA.
EXTRA = 8
_BASE = "doc_id long, rid long, n_shingles long, sid long, frequent long, weight long"
_PREFIX = "bucket int, keys binary, counts binary, sids binary, sizes binary"
_PAIRS = "home int, sids binary, pivots binary"
_MEMBER = "home int, pivot long, low int, high int, own int, sid long, shingles binary, pivots binary, weight long"
#: Shingles of a region that one task takes. Any choice is right.
REGION_SHINGLES = 1_000_000
#: Rows and columns of a block of overlaps, and the entries that are expanded at once. Any choice is right.
BLOCK, COLUMNS, EXPAND = 256, 4096, 4_000_000
#: Bytes of sets that a task sends on at once. Any choice is right.
SENT_BYTES = 4 << 20
#: Groups of regions, and of documents, for each bucket of the first shuffles. Any choice is right.
HOMES = 8


def shingle_sets(piece: tk.Piece, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending in each document, and each document's bounds."""
    data = tk.LOWER[piece.data]
    words = tk.find_words(data, piece.offs, tk.NOT_SPACE)
    names = tk.word_hashes(data, words)
    size = np.diff(words.bounds)
    count = np.where(size > 0, np.maximum(size - width + 1, 1), 0)
    doc = np.repeat(np.arange(piece.n), count)
    first = np.cumsum(count) - count
    at = words.bounds[doc] + np.arange(int(count.sum())) - first[doc]
    keys = tk.seq_hash(names, at, np.minimum(size, width)[doc])
    by = np.lexsort((keys, doc))
    keys, doc = keys[by], doc[by]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(piece.n + 1))


def set_ids(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A name of each set, the same for equal sets."""
    total = np.concatenate((np.zeros(1, tk.U64), np.cumsum(tk.mix(keys ^ tk.U64(0x5851F42D4C957F2D)), dtype=tk.U64)))
    return tk.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(tk.U64)).view(np.int64)


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """One row for each document, and rows of the shingles that are frequent in a piece."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, rid = batch.column("doc_id"), batch.column("rid")
            for piece in tk.pieces(batch.column("text")):
                keys, bounds = shingle_sets(piece, width)
                size = np.diff(bounds)
                sid = pa.array(set_ids(keys, bounds), mask=size == 0)
                none = pa.nulls(piece.n, pa.int64())
                here = [doc_id[piece.rows], rid[piece.rows], pa.array(size, pa.int64()), sid, none, none]
                yield pa.RecordBatch.from_arrays(here, names=[x.split()[0] for x in _BASE.split(", ")])
                found, weight = np.unique(keys, return_counts=True)
                often = weight >= max(4, piece.n // 50)
                if often.any():
                    none = pa.nulls(int(often.sum()), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(found[often].view(np.int64)), pa.array(weight[often], pa.int64())], names=[x.split()[0] for x in _BASE.split(", ")])

    return docs.select("doc_id", "rid", "text").mapInArrow(describe, _BASE)


def _prefixes(keys: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, percent: int, longer: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places of the shingles in the prefix of their document, and their documents."""
    size = np.diff(bounds)
    doc = np.repeat(np.arange(len(size)), size)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        late = frequent[place] == keys
    else:
        late = np.zeros(len(keys), bool)
    by = np.lexsort((keys, late, doc))
    nth = np.arange(len(keys)) - bounds[:-1][doc]
    take = size - (percent * size + 99) // 100 + 1 + (size // EXTRA if longer else 0)
    chosen = nth < np.minimum(take, size)[doc]
    return by[chosen], doc[chosen]


def needed(size: Column, percent: int) -> Column:
    """How many of the first shingles of a set must stand in another: what the smallest set that it can
    be linked with adds to its own."""
    return F.floor(F.ceil(size * percent / 100) / EXTRA) + 1


def _shared_prefixes(docs: DataFrame, frequent: Broadcast, buckets: int, width: int, percent: int) -> DataFrame:
    """(rid, at): which of the first shingles of each document stand in others."""

    def send(batch: pa.RecordBatch) -> Iterator[tuple]:
        rid = tk.i64(batch.column("rid"))
        for k, piece in enumerate(tk.pieces(batch.column("text"))):
            keys, bounds = shingle_sets(piece, width)
            at, doc = _prefixes(keys, bounds, frequent.value, percent, longer=True)
            base = np.searchsorted(doc, np.arange(piece.n))
            yield from repeats.entries(keys[at], np.arange(len(at)), rid[piece.rows], base, None, buckets, "any", True, int(rid[0]) + k)

    return repeats.find(docs, send, "any", True, buckets)


def _send_prefixes(docs: DataFrame, frequent: Broadcast, buckets: int, width: int, percent: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for piece in tk.pieces(batch.column("text")):
                keys, bounds = shingle_sets(piece, width)
                sid, size = set_ids(keys, bounds), np.diff(bounds)
                at, doc = _prefixes(keys, bounds, frequent.value, percent)
                to = ((keys[at] >> tk.U64(32)) * tk.U64(buckets) >> tk.U64(32)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                at, doc, to = at[by], doc[by], to[by]
                cuts = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    some, counts = np.unique(doc[a:b], return_counts=True)
                    rows.append((int(to[a]), keys[at[a:b]].astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes(), sid[some].tobytes(), size[some].astype(np.uint32).tobytes()))
            if rows:
                b, *blobs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), *map(tk.binary_column, blobs)], names=[x.split()[0] for x in _PREFIX.split(", ")])

    return docs.mapInArrow(send, _PREFIX)


def _home(x: np.ndarray, homes: int) -> np.ndarray:
    return ((tk.mix(x.view(tk.U64)) >> tk.U64(32)) * tk.U64(homes) >> tk.U64(32)).astype(np.int32)


def _cells(prefixes: DataFrame, homes: int, percent: int) -> DataFrame:
    """(sid, pivots): the pivots of the cells in which each point lies."""

    def pair(table: pa.Table) -> pa.Table:
        raw = {c: np.frombuffer(b"".join(x.as_py() for x in table.column(c)), k) for c, k in (("keys", np.uint32), ("counts", np.uint32), ("sids", np.int64), ("sizes", np.uint32))}
        sid, size = np.repeat(raw["sids"], raw["counts"]), np.repeat(raw["sizes"], raw["counts"]).astype(np.int64)
        # Only keys that several entries have.
        by = np.argsort(raw["keys"], kind="stable")
        k = raw["keys"][by]
        same = np.append(False, k[1:] == k[:-1])
        multi = same.copy()
        multi[:-1] |= same[1:]
        by = by[multi]
        key, sid, size = raw["keys"][by].astype(np.int64), sid[by], size[by]
        by = np.lexsort((sid, size, key))
        key, sid, size = key[by], sid[by], size[by]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
        key, sid, size = key[new], sid[new], size[new]
        if not len(key):
            return pa.schema([("home", pa.int32()), ("sids", pa.binary()), ("pivots", pa.binary())]).empty_table()
        # A cell ends where the next larger set is too large to be linked with any before it.
        cell = np.ones(len(key), bool)
        cell[1:] = (key[1:] != key[:-1]) | (size[:-1] * 100 < size[1:] * percent)
        head = np.flatnonzero(cell)
        count = np.diff(head, append=len(key))
        pivot = np.repeat(np.minimum.reduceat(sid, head), count)
        some = np.repeat(count > 1, count)
        sid, pivot = sid[some], pivot[some]
        home = _home(sid, homes)
        by = np.lexsort((pivot, sid, home))
        home, sid, pivot = home[by], sid[by], pivot[by]
        new = np.ones(len(sid), bool)
        new[1:] = (sid[1:] != sid[:-1]) | (pivot[1:] != pivot[:-1])
        home, sid, pivot = home[new], sid[new], pivot[new]
        head = np.flatnonzero(np.diff(home, prepend=-1))
        cuts = np.append(head, len(home))
        return pa.table([pa.array(home[head]), tk.ragged_binary(sid, cuts), tk.ragged_binary(pivot, cuts)], names=["home", "sids", "pivots"])

    def gather(table: pa.Table) -> pa.Table:
        sid, pivot = (np.frombuffer(b"".join(x.as_py() for x in table.column(c)), np.int64) for c in ("sids", "pivots"))
        by = np.lexsort((pivot, sid))
        sid, pivot = sid[by], pivot[by]
        new = np.ones(len(sid), bool)
        new[1:] = (sid[1:] != sid[:-1]) | (pivot[1:] != pivot[:-1])
        sid, pivot = sid[new], pivot[new]
        head = np.flatnonzero(np.append(True, sid[1:] != sid[:-1]))
        return pa.table([pa.array(sid[head]), tk.ragged_binary(pivot, np.append(head, len(sid)))], names=["sid", "pivots"])

    return prefixes.groupBy("bucket").applyInArrow(pair, _PAIRS).groupBy("home").applyInArrow(gather, "sid long, pivots binary")


def region_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph of all sets at Jaccard percent / 100 or more; sets are sorted.

    The first set is the pivot.  What is within reach of it is linked to it at once.  Points are ordered by
    their distance to it, and a block of them is compared with those that follow only inside the window that the
    triangle inequality leaves, and only while the window holds points that are not connected yet.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    mine = np.concatenate(sets)
    place = np.searchsorted(sets[0], mine)
    place[place == size[0]] = 0
    hit = np.concatenate(([0], np.cumsum(sets[0][place] == mine)))
    common = hit[ends] - hit[ends - size]
    union = size[0] + size - common
    near = np.flatnonzero(100 * common >= percent * union)
    root = np.arange(n)
    root[near] = 0
    links = [(0, int(y)) for y in near if y]
    if len(near) == n:
        return links
    distance = 1 - common / union
    distance[0] = 0
    order = np.argsort(distance, kind="stable")
    distance, size, root = distance[order], size[order], root[order]
    window = distance + (1 - percent / 100 + 1e-9)
    overlaps = Overlaps([sets[k] for k in order])
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        d = int(np.searchsorted(distance, window[b - 1], "right"))
        if (root[a:d] == root[a]).all():
            continue
        both = overlaps.block(a, b, a, d)
        linked = 100 * both >= percent * (size[a:b, None] + size[None, a:d] - both)
        for x in np.flatnonzero(linked.any(1)).tolist():
            at = np.flatnonzero(linked[x]) + a
            at = at[root[at] != root[a + x]]
            if len(at):
                for other, first in zip(*np.unique(root[at], return_index=True), strict=True):
                    links.append((int(order[a + x]), int(order[at[first]])))
                    root[root == other] = root[a + x]
    return links


class Overlaps:
    """Sizes of the intersections of sets, by blocks: keys that many sets have by products of 0-1 matrices,
    others by the lists of the sets that have them. Keys of a single set are left out, so a set's overlap with
    itself is not given."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        n, size = len(sets), np.array([len(x) for x in sets])
        row = np.repeat(np.arange(n), size)
        _, key, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        heavy = often > max(n // 16, 1)
        column = np.cumsum(heavy) - 1
        some = heavy[key]
        column, at = column[key[some]], row[some]
        self.chunks = []
        for c in range(0, int(heavy.sum()), COLUMNS):
            here = (column >= c) & (column < c + COLUMNS)
            self.chunks.append((at[here], column[here] - c))
        some = (often[key] > 1) & ~some
        self.row, self.key, self.often = row[some], key[some], often
        by = np.argsort(self.key, kind="stable")
        self.rows_of, self.first = self.row[by], np.searchsorted(self.key[by], np.arange(len(often)))

    def block(self, a: int, b: int, c: int, d: int) -> np.ndarray:
        """Of sets a to b, by row, with sets c to d."""
        out = np.zeros((b - a, d - c), np.int64)
        for rows, columns in self.chunks:
            wide = int(columns.max()) + 1

            def dense(x: int, y: int) -> np.ndarray:
                i, j = np.searchsorted(rows, (x, y))
                m = np.zeros((y - x, wide), np.float32)
                m[rows[i:j] - x, columns[i:j]] = 1
                return m

            left = dense(a, b)
            for x in range(c, d, BLOCK):
                y = min(x + BLOCK, d)
                out[:, x - c : y - c] += (left @ dense(x, y).T).astype(np.int64)
        i, j = np.searchsorted(self.row, (a, b))
        upto = np.concatenate(([0], np.cumsum(self.often[self.key[i:j]])))
        while i < j:
            k = i + max(int(np.searchsorted(upto - upto[0], EXPAND, "right")) - 1, 1)
            k = min(k, j)
            key, many = self.key[i:k], self.often[self.key[i:k]]
            nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            other = self.rows_of[np.repeat(self.first[key], many) + nth]
            mine = np.repeat(self.row[i:k], many)
            here = (other >= c) & (other < d)
            out += np.bincount((mine[here] - a) * (d - c) + other[here] - c, minlength=out.size).reshape(out.shape)
            upto, i = upto[k - i :], k
        return out


def region_counts(sets: list[np.ndarray], weight: np.ndarray, smaller: list[np.ndarray], percent: int = PERCENT, own: np.ndarray | None = None) -> np.ndarray:
    """How many documents each set is linked with, by pairs of different sets that have no smaller pivot
    in common; weight has the documents of each set. own has the block of each set if only pairs from
    different blocks count."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size, mine = size[order], weight[order]
    own = np.arange(len(sets)) if own is None else own[order]
    common, other = Overlaps([sets[k] for k in order]), Overlaps([smaller[k] for k in order])
    counts = np.zeros(len(sets), np.int64)
    for a in range(0, len(sets), BLOCK):
        b = min(a + BLOCK, len(sets))
        d = int(np.searchsorted(size * percent, size[b - 1] * 100, "right"))
        both = common.block(a, b, a, d)
        linked = 100 * both >= percent * (size[a:b, None] + size[None, a:d] - both)
        linked &= np.arange(a, b)[:, None] < np.arange(a, d)[None, :]
        linked &= own[a:b, None] != own[None, a:d]
        if linked.any():
            linked &= other.block(a, b, a, d) == 0
            counts[a:b] += linked @ mine[a:d]
            counts[a:d] += mine[a:b] @ linked
    out = np.zeros_like(counts)
    out[order] = counts
    return out


def _large_regions(members: DataFrame) -> DataFrame:
    """(pivot, blocks) of the regions that are dealt to several blocks."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("pivots")]
            if each:
                pivot, place = np.unique(np.concatenate(each), return_inverse=True)
                n = np.bincount(place, np.repeat(np.asarray(batch.column("n")), [len(x) for x in each]))
                yield pa.RecordBatch.from_arrays([pa.array(pivot), pa.array(n.astype(np.int64))], names=["pivot", "n"])

    sizes = members.select("pivots", "n").mapInArrow(tally, "pivot long, n long").groupBy("pivot").agg(F.sum("n").alias("n"))
    return sizes.where(F.col("n") > REGION_SHINGLES).select("pivot", F.ceil(F.col("n") / REGION_SHINGLES).cast("long").alias("blocks"))


def _with_blocks(members: DataFrame) -> DataFrame:
    """members with ``split``, the numbers of blocks of those of its pivots that have several. All is one
    query, in which the shuffles below members are used again; a job of its own would shuffle texts anew."""
    large = _large_regions(members)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("pivots")]
            if each:
                rid = np.repeat(np.asarray(batch.column("rid")), [len(x) for x in each])
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(np.concatenate(each))], names=["rid", "pivot"])

    split = members.select("rid", "pivots").mapInArrow(unpack, "rid long, pivot long").join(large, "pivot")
    return members.join(split.groupBy("rid").agg(F.collect_list(F.struct("pivot", "blocks")).alias("split")), "rid", "left")


def jaccard_links(documents: DataFrame, width: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rid, n_shingles, sid) of each document, and links (a, b) between sids of a spanning forest.

    Documents with one sid have equal sets; links between others that a spanning forest leaves out join
    points that it connects already.
    """
    base, found = _join(documents, width, percent, False)
    return base, found.where("b is not null").select("a", "b")


def _join(documents: DataFrame, width: int, percent: int, counted: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rid, n_shingles, sid) of each document, and rows (a, b, n): links between sids of a spanning
    forest and, if counted, rows without b of how many documents with other sets a is linked with.

    Documents with one sid have equal sets; links between others that a spanning forest leaves out join
    points that it connects already.
    """
    docs = repeats.with_row_id(documents)
    described = cut(_describe(docs, width))
    docs = docs.select("rid", "text")
    base = described.where("frequent is null").select("doc_id", "rid", "n_shingles", "sid")
    often = described.where("frequent is not null").groupBy("frequent").agg(F.sum("weight").alias("weight"))
    often = [r[0] for r in often.orderBy(F.desc("weight"), "frequent").limit(FREQUENT).collect()]
    frequent = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(often, np.int64).view(tk.U64)))
    buckets = repeats.buckets_for(docs)
    # One document stands for each set. All joins read the same columns of docs, so its texts are
    # shuffled once.
    points = base.where("sid is not null").groupBy("sid").agg(F.min("rid").alias("rid"), F.first("n_shingles").alias("n"), F.count("*").alias("weight"))
    shared = _shared_prefixes(docs.join(points.select("rid"), "rid").select("rid", "text"), frequent, buckets, width, percent)
    likely = shared.join(points, "rid").where(repeats.reported("at") >= needed(F.col("n"), percent)).select("rid", "sid", "n", "weight")
    likely = cut(likely)
    sent = _send_prefixes(docs.join(likely.select("rid"), "rid").select("rid", "text"), frequent, buckets, width, percent)
    members = _with_blocks(_cells(sent, max(buckets, 4), percent).join(likely, "sid").select("rid", "pivots", "n", "weight"))

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tk.pieces(batch.column("text"), 1 << 19):
                keys, bounds = shingle_sets(piece, width)
                sid = set_ids(keys, bounds)
                rows, held = [], 0
                for d, k in enumerate(range(piece.rows.start, piece.rows.stop)):
                    body = keys[bounds[d] : bounds[d + 1]].tobytes()
                    pivots = np.frombuffer(batch.column("pivots")[k].as_py(), np.int64)
                    weight = batch.column("weight")[k].as_py()
                    blocks = {x["pivot"]: x["blocks"] for x in batch.column("split")[k].as_py() or ()}
                    for i, (h, p) in enumerate(zip(_home(pivots, homes).tolist(), pivots.tolist(), strict=True)):
                        # A set goes out once for each pivot and block, so batches are bounded by bytes.
                        if held > SENT_BYTES:
                            yield member_batch(rows)
                            rows, held = [], 0
                        # Pivots ascend: those before each one are the smaller ones.
                        rest = int(sid[d]), body, pivots[:i].tobytes() if counted else b"", weight
                        if p not in blocks:
                            rows.append((h, p, 0, 0, 0, *rest))
                            held += len(body) + len(rest[2])
                            continue
                        own = int(tk.mix(sid[d : d + 1].view(tk.U64) + tk.U64(p & (1 << 63) - 1))[0] % tk.U64(blocks[p]))
                        pairs = np.array([(min(own, x), max(own, x)) for x in range(blocks[p])])
                        to = _home(p ^ (pairs[:, 0] << 32 | pairs[:, 1]), homes)
                        for t, (low, high) in zip(to.tolist(), pairs.tolist(), strict=True):
                            rows.append((t, p, low, high, own, *rest))
                            held += len(body) + len(rest[2])
                            if held > SENT_BYTES:
                                yield member_batch(rows)
                                rows, held = [], 0
                if rows:
                    yield member_batch(rows)

    def member_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _MEMBER.split(", ")])

    def link(table: pa.Table) -> pa.Table:
        pivot, low, high, own, sid = (np.asarray(table.column(c)) for c in ("pivot", "low", "high", "own", "sid"))
        task = low.astype(np.int64) << 32 | high
        by = np.lexsort((sid, task, pivot))
        pivot, task, sid = pivot[by], task[by], sid[by]
        same = (pivot[1:] == pivot[:-1]) & (task[1:] == task[:-1])
        new = np.append(True, ~same | (sid[1:] != sid[:-1]))
        head = np.append(True, ~same)[new]
        by, pivot, sid = by[new], pivot[new], sid[new]
        body, smaller, weight = table.column("shingles"), table.column("pivots"), np.asarray(table.column("weight"))
        head = np.flatnonzero(head)
        left, right, number = [], [], []
        for a, b in zip(head, np.append(head[1:], len(pivot)), strict=True):
            if b - a < 2:
                continue
            # The pivot of the region is its first point.
            order = a + np.argsort(sid[a:b] != pivot[a], kind="stable")
            sets = [np.frombuffer(body[int(by[k])].as_py(), tk.U64) for k in order]
            for x, y in region_links(sets, percent):
                left.append(sid[order[x]])
                right.append(sid[order[y]])
                number.append(None)
            if counted:
                before = [np.frombuffer(smaller[int(by[k])].as_py(), np.int64) for k in order]
                first = by[order[0]]
                counts = region_counts(sets, weight[by[order]], before, percent, own[by[order]] if low[first] != high[first] else None)
                for x in np.flatnonzero(counts).tolist():
                    left.append(sid[order[x]])
                    right.append(None)
                    number.append(int(counts[x]))
        return pa.table([pa.array(x, pa.int64()) for x in (left, right, number)], names=["a", "b", "n"])

    homes = buckets * HOMES
    regions = docs.join(members, "rid").select("rid", "text", "pivots", "weight", "split").mapInArrow(ship, _MEMBER)
    return base, cut(regions.groupBy("home").applyInArrow(link, "a long, b long, n long"))


def jaccard_components(documents: DataFrame, width: int = WORDS, percent: int = PERCENT, counted: bool = True) -> DataFrame:
    """(doc_id, rid, n_shingles, component, component_id, n_links) of each document; component names it by a
    set, null without shingles, component_id by its smallest doc_id; n_links is the number of other documents
    that it is linked with, left out unless counted."""
    base, found = _join(documents, width, percent, counted)
    labels = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "sid")
    # One row for each distinct set, then each document takes over what its set has.
    points = base.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    points = points.join(labels, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = points.groupBy("component").agg(F.min("first").alias("component_id"))
    points = points.join(least, "component").select("sid", "component", "component_id", "copies")
    extra = []
    if counted:
        others = found.where("b is null").groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("others"))
        points = points.join(others, "sid", "left")
        extra = [F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).alias("n_links")]
    # Both sides come from shuffles of their own, so that a set with many copies can be split.
    joined = base.join(cut(points), "sid", "left")
    own = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "rid", "n_shingles", "component", own.alias("component_id"), *extra)


def one_of_each(documents: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those that a smaller doc_id of their component stands for."""
    found = jaccard_components(documents, width, percent, False).where("component is not null")
    found = cut(found.select("component", "doc_id", "rid"))
    lead = found.groupBy("component").agg(F.min(F.struct("doc_id", "rid")).alias("lead")).select(F.col("lead.rid").alias("rid"))
    # Rows that repeat a leading row are few: they are set apart and made one.
    often = found.groupBy("rid").count().where("count > 1").join(lead, "rid", "left_semi").select("rid")
    gone = found.join(lead, "rid", "left_anti").select("rid").distinct().unionByName(often)
    rows = documents.select(F.xxhash64("doc_id", "text").alias("rid"), F.struct(*documents.columns).alias("row"))
    once = rows.join(often, "rid", "left_semi").dropDuplicates(["rid"])
    kept = rows.join(gone, "rid", "left_anti")
    return kept.unionByName(once).select(*[F.col("row")[c].alias(c) for c in documents.columns])
