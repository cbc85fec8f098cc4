"""Source divergence audit: how far the sources of a language are apart in their vocabulary (operator 11).

A group is a (lang, source) that occurs; null counts as ''.  A language keeps the terms that stand in at
least ``KEEP`` of its documents.  Each group, and each language as a whole, gives each kept term a share of
``SCALE``, smoothed, in whole numbers.

1. Documents become counts of (lang, source, term), first inside a task, then over the corpus.
   They are dealt by (lang, term), so a task has all groups of a term and keeps or drops it at once.
2. The counts of consecutive terms are packed: a chunk has up to ``CHUNK`` terms of a language, and a row for
   each block of about ``BLOCK`` groups, with group, term and count of each entry.
3. Two-dimensional tiling: a task is a pair of blocks.  Each packed row goes to the tasks of its block with
   every other, where rows arrive chunk by chunk.  A task holds the submatrix of its pairs and one chunk of
   two blocks, and adds up what each chunk has.  A term that neither group has costs nothing: what all terms
   would add without any counts is added once, and a chunk adds what differs from that.  Languages with very
   many counts are dealt to several ranges of chunks (``SPAN_ROWS``).

Part ``pair`` has each other source of the language, all ranks; part ``term`` the ``TOP`` terms that a group
uses more than its language.

Defined results: a null text has no term; every row is a document, so repeated rows count again; a language
that keeps no term has pairs of value 0; a language of one source has no pair; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import textkit as tk
from .shared import bounded_batches, bytes_of, cut

KEEP, TOP = 30, 50
SCALE, SMOOTH = 1_000_000_000, 5
#: Groups of a block, terms and counts of a chunk, counts that one task of a pair of blocks goes through, bytes of input
#: for a partition of counts, counts that a task combines at once, groups whose languages are broadcast. Any
#: choice is right.
BLOCK, CHUNK, CHUNK_ROWS, SPAN_ROWS, PART_BYTES, COMBINE, FEW = 64, 4096, 500_000, 50_000_000, 8 << 20, 500_000, 1_000_000
_COUNTS = "lang string, source string, term string, n long, docs long"
_TILE = "lang string, lo int, hi int, span int, chunk long, block int, sources array<string>, at binary, term binary, n binary, kept long"
_PAIR = "lang string, source string, item string, value long"
_TILES = pa.schema([("lang", pa.string()), ("lo", pa.int32()), ("hi", pa.int32()), ("span", pa.int32()), ("chunk", pa.int64()), ("block", pa.int32()), ("sources", pa.list_(pa.string())), ("at", pa.binary()), ("term", pa.binary()), ("n", pa.binary()), ("kept", pa.int64())])


def _names(shape: str) -> list[str]:
    return [x.split()[0] for x in shape.split(", ")]


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of each piece."""
    for batch in batches:
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        sources = max(len(source.dictionary), 1)
        group = np.asarray(lang.indices).astype(np.int64) * sources + np.asarray(source.indices)
        for piece in tk.pieces(batch.column("text")):
            doc, term, count, names, _ = tk.terms(piece, tk.ALPHA)
            if not len(doc):
                continue
            key = group[piece.rows][doc] * len(names) + term
            by = np.argsort(key, kind="stable")
            head = np.flatnonzero(np.append(True, np.diff(key[by]) != 0))
            g, t = np.divmod(key[by][head], len(names))
            cols = [lang.dictionary.take(pa.array(g // sources)), source.dictionary.take(pa.array(g % sources)), names.take(pa.array(t)), pa.array(np.add.reduceat(count[by], head)), pa.array(np.diff(head, append=len(by)))]
            yield pa.RecordBatch.from_arrays(cols, names=_names(_COUNTS))


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same, added up over the pieces of a task; what does not shrink is sent on."""

    def total(parts: list[pa.RecordBatch]) -> pa.Table:
        rows = pa.Table.from_batches(parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return rows.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(_names(_COUNTS))

    held, rows = [], 0
    for part in count_terms(batches):
        held.append(part)
        rows += part.num_rows
        if rows > COMBINE:
            table = total(held)
            held, rows = table.to_batches(), table.num_rows
            if rows > COMBINE // 2:
                yield from table.to_batches(max_chunksize=100_000)
                held, rows = [], 0
    if held:
        yield from total(held).to_batches(max_chunksize=100_000)


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / total) without rounding, by long division in thousands; a total
    is below 9 * 10**15."""
    out = np.ones(np.broadcast(count, total).shape, np.int64)
    rest, unit = np.asarray(count, np.int64) + SMOOTH, SCALE
    while unit > 1:
        unit //= 1000
        q, rest = np.divmod(rest * 1000, total)
        out += q * unit
    return out


def share(count: str, total: str) -> Column:
    """The same as a column."""
    return F.expr(f"1 + (CAST({count} + {SMOOTH} AS DECIMAL(20, 0)) * {SCALE}BD) div {total}")


def _replicated(lang: str, block: int, blocks: int, span: int, chunk: int, rest: tuple) -> Iterator[tuple]:
    for other in range(blocks):
        yield lang, min(block, other), max(block, other), span, chunk, block, *rest


def _tiles(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TILES, strict=True)], schema=_TILES)


def pack(spans: int):
    """From counts, ordered by lang and term, to packed rows for each pair of blocks."""

    def chunk_rows(part: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        source = part.column("source").combine_chunks().dictionary_encode()
        name, block, n = np.asarray(source.indices), np.asarray(part.column("block")), np.asarray(part.column("n"))
        term = np.cumsum(np.asarray(part.column("lead"))) - 1
        lang, blocks = part.column("lang")[0].as_py(), part.column("blocks")[0].as_py()
        rows = []
        for b in np.unique(block).tolist():
            some = np.flatnonzero(block == b)
            used, at = np.unique(name[some], return_inverse=True)
            rest = source.dictionary.take(pa.array(used)).to_pylist(), at.astype(np.uint32).tobytes(), term[some].astype(np.uint32).tobytes(), n[some].tobytes(), None
            for row in _replicated(lang, b, blocks, me % spans, (me << 32) + number, rest):
                rows.append(row)
                if len(rows) == BLOCK:
                    yield _tiles(rows)
                    rows = []
        if rows:
            yield _tiles(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, 0
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            while held.num_rows:
                # The first terms of the first language, up to a chunk, if what follows them is there.
                lang = held.column("lang").combine_chunks()
                other = np.flatnonzero(~np.asarray(pa.compute.equal(lang, lang[0])))
                end = int(other[0]) if len(other) else held.num_rows
                heads = np.flatnonzero(np.asarray(held.column("lead"))[:end])
                terms = min(max(int(np.searchsorted(heads, CHUNK_ROWS)), 1), CHUNK)
                if len(heads) > terms:
                    end = int(heads[terms])
                elif not len(other):
                    break
                yield from chunk_rows(held.slice(0, end), number)
                held, number = held.slice(end), number + 1
        if held is not None and held.num_rows:
            yield from chunk_rows(held, number)

    return run


class Tile:
    """The submatrix of a pair of blocks, over the chunks that were added."""

    def __init__(self, first: dict):
        self.key = first["lang"], first["lo"], first["hi"]
        self.with_base = first["span"] == 0
        self.names: dict[int, list[str]] = {}
        self.total: dict[int, np.ndarray] = {}
        self.kept = 0
        self.sums: np.ndarray | None = None
        self.chunk: tuple[int, dict[int, tuple]] = -1, {}

    def add(self, row: dict) -> None:
        b = row["block"]
        if row["chunk"] < 0:  # the groups of a block come before all chunks
            self.names.setdefault(b, []).extend(row["sources"])
            self.total[b] = np.append(self.total.get(b, np.zeros(0, np.int64)), np.frombuffer(row["n"], np.int64))
            self.kept = row["kept"]
            return
        if row["chunk"] != self.chunk[0]:
            self.flush()
            self.chunk = row["chunk"], {}
        place = {s: k for k, s in enumerate(self.names[b])}
        mine = np.array([place[s] for s in row["sources"]])
        self.chunk[1][b] = mine[np.frombuffer(row["at"], np.uint32)], np.frombuffer(row["term"], np.uint32), np.frombuffer(row["n"], np.int64)

    def _none(self, b: int) -> np.ndarray:
        """The share of a term that a group has not."""
        return shares(np.zeros(len(self.total[b]), np.int64), self.total[b]) if self.kept else np.zeros(len(self.total[b]), np.int64)

    def flush(self) -> None:
        if not self.chunk[1]:
            return
        _, lo, hi = self.key
        if lo not in self.names or hi not in self.names:
            self.chunk = -1, {}
            return
        used = np.unique(np.concatenate([x[1] for x in self.chunk[1].values()]))
        dense = {}
        for b in {lo, hi}:
            dense[b] = np.repeat(self._none(b)[:, None], len(used), 1)
            if b in self.chunk[1]:
                at, term, n = self.chunk[1][b]
                dense[b][at, np.searchsorted(used, term)] = shares(n, self.total[b][at])
        if self.sums is None:
            self.sums = np.zeros((len(dense[lo]), len(dense[hi])), np.int64)
        for k, row in enumerate(dense[lo]):
            self.sums[k] += np.abs(dense[hi] - row).sum(1)
        self.sums -= len(used) * np.abs(self._none(lo)[:, None] - self._none(hi)[None, :])
        self.chunk = -1, {}

    def pairs(self) -> pa.RecordBatch | None:
        self.flush()
        lang, lo, hi = self.key
        if lo not in self.names or hi not in self.names:
            return None
        base = np.abs(self._none(lo)[:, None] - self._none(hi)[None, :]) * (self.kept if self.with_base else 0)
        value = base if self.sums is None else base + self.sums
        i, j = np.indices(value.shape).reshape(2, -1)
        if lo == hi:
            i, j = i[i != j], j[i != j]
        left, right = pa.array(self.names[lo], pa.string()).take(pa.array(i)), pa.array(self.names[hi], pa.string()).take(pa.array(j))
        both = [left, right, pa.array(value[i, j])]
        if lo != hi:
            both = [pa.concat_arrays([left, right]), pa.concat_arrays([right, left]), pa.array(np.tile(value[i, j], 2))]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(both[2]), pa.string()), *both], names=_names(_PAIR))


def submatrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition come ordered by tile and chunk; one tile is held at a time."""
    tile, key = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in _TILES.names}
            if key != (row["lang"], row["lo"], row["hi"], row["span"]):
                if tile is not None and (found := tile.pairs()) is not None:
                    yield found
                tile, key = Tile(row), (row["lang"], row["lo"], row["hi"], row["span"])
            tile.add(row)
    if tile is not None and (found := tile.pairs()) is not None:
        yield found


def source_divergence(documents: DataFrame, keep: int = KEEP, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): for each group how far each other source of its language is,
    and which terms it has more of than its language."""
    bounded_batches(documents.sparkSession)
    docs = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    parts = max(bytes_of(documents) // PART_BYTES, documents.sparkSession.sparkContext.defaultParallelism)
    groups = cut(docs.select("lang", "source").distinct())
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    if groups.count() <= FEW:  # else a join by lang, whose large languages are split
        blocks = F.broadcast(blocks)

    # One shuffle by (lang, term) serves the counts of groups, of documents and of the language.
    each = docs.mapInArrow(combined, _COUNTS).join(blocks, "lang").repartition(parts, "lang", "term")
    each = each.groupBy("lang", "source", "term", "blocks").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    kept = each.select(
        "lang", "source", "term", "blocks", "n", F.sum("docs").over(term).alias("docs"), F.sum("n").over(term).alias("lang_n"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("lead"), F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block"),
    ).where(F.col("docs") >= keep)
    kept = cut(kept.sortWithinPartitions("lang", "term", "source"))

    langs = kept.groupBy("lang").agg(F.count_if("lead").alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang")
    smooth = F.coalesce("v", F.lit(0)) * SMOOTH
    known = cut(known.select("lang", "source", "blocks", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("total", F.lit(0)) + smooth).alias("total"), (F.coalesce("lang_total", F.lit(0)) + smooth).alias("lang_total")))

    spans = int(kept.count() // SPAN_ROWS) + 1

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups with their totals, ahead of all chunks, to each tile of their block."""
        for batch in batches:
            for row in batch.to_pylist():
                rest = [row["source"]], b"", b"", np.int64(row["total"]).tobytes(), row["v"]
                told = [r for span in range(spans) for r in _replicated(row["lang"], row["block"], row["blocks"], span, -1, rest)]
                for k in range(0, len(told), 1000):
                    yield _tiles(told[k : k + 1000])

    heads = known.select("lang", "source", "blocks", "v", "total", F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("block")).mapInArrow(announce, _TILE)
    bodies = kept.select("lang", "source", "blocks", "block", "n", "lead").mapInArrow(pack(spans), _TILE)
    tiles = heads.unionByName(bodies).repartition(parts, "lang", "lo", "hi", "span").sortWithinPartitions("lang", "lo", "hi", "span", "chunk", "block")
    pairs = tiles.mapInArrow(submatrices, _PAIR).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    p, q = share("n", "total"), share("lang_n", "lang_total")
    terms = kept.join(known.select("lang", "source", "total", "lang_total"), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")

    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT x.lang, source, term, n,
         1 + CAST(1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY x.lang, source) + 5 * v.v) AS BIGINT) AS p,
         1 + CAST(1000000000::HUGEINT * (lang_n + 5) // (v.total + 5 * v.v) AS BIGINT) AS q
  FROM x JOIN v ON v.lang = x.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
