"""Ranked lexical search by TPUT over term-partitioned postings (operator 12).

Documents become postings of the items' terms, dealt by term: for each piece of text a row with the
documents that have the term, how often, and how long they are.  A posting's impact is what one document
gets for one term, but for the term's weight.  Three phases find the ``k`` best documents of each item:

1. Each list gives its head, the ``k`` postings of the highest impact.  The k-th highest sum over the heads
   of an item's lists is a lower bound t1 of its k-th score.
2. Each list sends every posting that reaches the uniform threshold t1 / m of an item with m terms; a
   document below it in all lists cannot reach t1.  A posting goes out once, whatever the number of items, to
   the task of its document.  There sums become lower bounds, and with what unsent postings could add, upper
   bounds.  The k-th highest lower bound, t2, leaves the candidates.
3. The candidates' postings below the threshold are looked up, which makes their scores exact.

Lists of frequent terms are dealt to several tasks by document (``LIST_BYTES``).  Items are searched in blocks
of ``BLOCK_BYTES``; a block's terms are broadcast.

Defined results: a null or empty text has no terms; an item without terms, or whose terms stand nowhere, has
no rows; items that repeat item_id and text are one; items of one item_id with different texts have ranks of
their own; every row of documents is a document, and a null doc_id comes first among equal scores; empty
tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from . import textkit as tk
from .shared import bounded_batches, bytes_of, cut, item_blocks

BEST = 50
BLOCK_BYTES = 4 << 20
#: Bytes of documents for each part of a list and for each task of documents, items that are added up at
#: once, sums that are made at once. Any choice is right.
LIST_BYTES, TASK_BYTES, ITEMS, EXPAND = 1 << 30, 8 << 20, 256, 1_000_000
_LIST = "code int, salt int, base long, offs binary, tf binary, n binary, ids binary, docs long, words long"
_SENT = "base long, code int, offs binary, impact binary, ids binary"
_CANDIDATE = "base long, off long, doc_id long, q int, low long, high long"
_LISTS = pa.schema([("code", pa.int32()), ("salt", pa.int32()), ("base", pa.int64()), *[(c, pa.binary()) for c in ("offs", "tf", "n", "ids")], ("docs", pa.int64()), ("words", pa.int64())])
_NONE = -(2**63)


def _names(shape: str) -> list[str]:
    return [x.split()[0] for x in shape.split(", ")]


def _joined(col: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of all rows, and the row of each."""
    data, offs = tk.string_buffers(col)
    size = np.diff(offs) // kind().itemsize
    return np.frombuffer(data.tobytes(), kind), np.repeat(np.arange(len(size)), size)


@dataclass
class Items:
    """The terms of a block of items."""

    vocabulary: pa.Array
    bounds: np.ndarray  # owners[bounds[c]:bounds[c + 1]] are the items that have term c
    owners: np.ndarray
    sizes: np.ndarray  # terms of each item

    @staticmethod
    def of(texts: list[str | None]) -> Items:
        data, offs = tk.string_buffers(pa.array([t or "" for t in texts], pa.large_string()))
        item, code, _, names, _ = tk.terms(tk.Piece(data, offs, slice(0, len(texts))), tk.ALNUM)
        by = np.argsort(code, kind="stable")
        return Items(names, np.searchsorted(code[by], np.arange(len(names) + 1)), item[by], np.bincount(item, minlength=len(texts)))

    def expanded(self, code: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(posting, item) for the items from low to below high that have the posting's term, in parts."""
        terms, n = np.arange(len(self.bounds) - 1), len(self.sizes)
        key = np.repeat(terms, np.diff(self.bounds)) * n + self.owners  # owners ascend for each term
        first, last = np.searchsorted(key, terms * n + low), np.searchsorted(key, terms * n + high)
        many = (last - first)[code]
        upto = np.append(0, np.cumsum(many))
        at = 0
        while at < len(code):
            to = min(max(int(np.searchsorted(upto, upto[at] + EXPAND, "right")) - 1, at + 1), len(code))
            m = many[at:to]
            nth = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            yield np.repeat(np.arange(at, to), m), self.owners[np.repeat(first[code[at:to]], m) + nth]
            at = to


@dataclass
class Scoring:
    """What scores need besides postings: documents and words of the corpus, and the terms' weights."""

    docs: int
    words: int
    weight: np.ndarray

    @staticmethod
    def of(docs: int, words: int, df: np.ndarray) -> Scoring:
        return Scoring(docs, words, np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        tf, length = tf.astype(np.int64), 50 * n.astype(np.int64)
        if len(n) and int(length.max()) * self.docs >= 1 << 63:
            length = np.array([x * self.docs // self.words for x in length.tolist()], np.int64)
        else:
            length = length * self.docs // max(self.words, 1)
        return 1_000_000_000 * tf // (1000 * tf + 20 * (100 - 50 + length))


def _scan(items: Items, salts: int):
    """Postings of each piece, a row for each term, and a row without term that says which documents it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_id = tk.i64(batch.column("doc_id"))
            for piece in tk.pieces(batch.column("text")):
                doc, term, tf, names, words = tk.terms(piece, tk.ALNUM)
                code = np.asarray(pc.fill_null(pc.index_in(names, value_set=items.vocabulary), -1)) if len(names) else np.zeros(0, np.int64)
                code = code[term]
                by = np.argsort(code, kind="stable")
                by = by[np.searchsorted(code[by], 0) :]
                heads = np.flatnonzero(np.append(True, np.diff(code[by]) != 0)) if len(by) else np.zeros(0, np.int64)
                cuts = np.append(heads, len(by))
                rows = len(heads)
                body = [tk.ragged_binary(x.astype(np.uint32), cuts) for x in (doc[by], tf[by], words[doc[by]])] if rows else [pa.array([], pa.binary())] * 3
                salt = int(tk.mix(np.array([base], tk.U64))[0] >> tk.U64(33))
                yield pa.RecordBatch.from_arrays([pa.array(code[by][heads].astype(np.int32)), pa.array([salt % salts] * rows, pa.int32()), pa.array([base] * rows, pa.int64()), *body, pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], schema=_LISTS)
                told = [-1, salt, base, None, None, None, doc_id[piece.rows].tobytes(), int((words > 0).sum()), int(words.sum())]
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(told, _LISTS, strict=True)], schema=_LISTS)
                base += piece.n

    return run


def _heads(scoring: Scoring, k: int):
    """The k postings of highest impact of each list, or of its part in this partition. Lists come one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            if not batch.num_rows:
                continue
            code, base = np.asarray(batch.column("code")), np.asarray(batch.column("base"))
            tf, row = _joined(batch.column("tf"), np.uint32)
            impact = scoring.impact(tf, _joined(batch.column("n"), np.uint32)[0])
            doc = base[row] + _joined(batch.column("offs"), np.uint32)[0]
            c, d, i = (np.concatenate(x) for x in zip(held, (code[row], doc, impact), strict=True))
            by = np.lexsort((d, -i, c))
            c, d, i = c[by], d[by], i[by]
            top = np.arange(len(c)) - np.searchsorted(c, c) < k
            c, d, i = c[top], d[top], i[top]
            open_ = c == code[-1]  # the list may go on in the next batch
            held = c[open_], d[open_], i[open_]
            yield pa.RecordBatch.from_arrays([pa.array(x[~open_]) for x in (c, d, i)], names=["code", "doc", "impact"])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["code", "doc", "impact"])

    return run


def _send(scoring: Scoring, wanted):
    """Postings that ``wanted(code, weighed impact)`` says are sent, and rows without term as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.asarray(batch.column("code"))
            tf, row = _joined(batch.column("tf"), np.uint32)
            impact = scoring.impact(tf, _joined(batch.column("n"), np.uint32)[0])
            go = wanted(code[row], impact * scoring.weight[code[row]]) if len(row) else np.zeros(0, bool)
            cuts = np.append(0, np.cumsum(np.bincount(row[go], minlength=batch.num_rows)))
            told = np.asarray(batch.column("ids").is_valid())
            kept = np.flatnonzero((np.diff(cuts) > 0) | told)
            offs = _joined(batch.column("offs"), np.uint32)[0][go]
            out = [batch.column("base"), batch.column("code"), tk.ragged_binary(offs, cuts), tk.ragged_binary(impact[go].astype(np.uint32), cuts), batch.column("ids")]
            yield pa.RecordBatch.from_arrays([x.take(pa.array(kept)) for x in out], names=_names(_SENT))

    return run


def _postings(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document key, code, impact) of packed rows."""
    offs, row = _joined(table.column("offs"), np.uint32)
    impact = _joined(table.column("impact"), np.uint32)[0].astype(np.int64)
    return np.asarray(table.column("base"))[row] + offs, np.asarray(table.column("code"))[row], impact


def _bounds(items: Items, scoring: Scoring, t1: np.ndarray, least: np.ndarray, k: int):
    """Candidates of some documents: lower and upper bounds of each item's scores."""

    def run(table: pa.Table) -> pa.Table:
        told = table.filter(table.column("ids").is_valid())
        base = np.asarray(told.column("base"))
        ids, row = _joined(told.column("ids"), np.int64)
        key = base[row] + np.arange(len(row)) - np.searchsorted(row, row)
        by = np.argsort(key)
        key, ids, row = key[by], ids[by], row[by]
        doc, code, impact = _postings(table.filter(table.column("ids").is_null()))
        doc = np.searchsorted(key, doc)
        gain = impact * scoring.weight[code]
        found = []
        for a in range(0, len(items.sizes), ITEMS):
            b = min(a + ITEMS, len(items.sizes))
            low, seen = np.zeros((b - a, len(key)), np.int64), np.zeros((b - a, len(key)), np.int32)
            for posting, item in items.expanded(code, a, b):
                go = gain[posting] >= least[item]
                posting, item = posting[go], item[go] - a
                np.add.at(low, (item, doc[posting]), gain[posting])
                np.add.at(seen, (item, doc[posting]), 1)
            high = low + (items.sizes[a:b, None] - seen) * (least[a:b, None] - 1)
            bound = np.maximum(t1[a:b], 1)
            if len(key) > k:
                bound = np.maximum(bound, np.partition(low, len(key) - k, 1)[:, len(key) - k])
            item, d = np.nonzero(high >= bound[:, None])
            found.append((base[row[d]], key[d] - base[row[d]], ids[d], item + a, low[item, d], high[item, d]))
        b, off, doc_id, q, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([pa.array(b), pa.array(off), pa.array(doc_id, mask=doc_id == _NONE), pa.array(q.astype(np.int32)), pa.array(low), pa.array(high)], names=_names(_CANDIDATE))

    return run


def _exact(items: Items, scoring: Scoring, least: np.ndarray):
    """Scores of the candidates: what was sent, and what is looked up now."""

    def run(table: pa.Table) -> pa.Table:
        told = table.filter(table.column("q").is_valid())
        q, score = np.asarray(told.column("q")).astype(np.int64), np.array(told.column("low"))
        key, mine = np.unique(np.asarray(told.column("base")) + np.asarray(told.column("off")), return_inverse=True)
        by = np.lexsort((mine, q))
        sought = q[by] * max(len(key), 1) + mine[by]
        doc, code, impact = _postings(table.filter(table.column("q").is_null()))
        place = np.minimum(np.searchsorted(key, doc), max(len(key) - 1, 0))
        known = key[place] == doc if len(key) else np.zeros(len(doc), bool)
        place, code, gain = place[known], code[known], (impact * scoring.weight[code])[known]
        for posting, item in items.expanded(code, 0, len(items.sizes)):
            go = gain[posting] < least[item]
            posting, item = posting[go], item[go]
            want = item * len(key) + place[posting]
            at = np.minimum(np.searchsorted(sought, want), max(len(sought) - 1, 0))
            hit = sought[at] == want
            np.add.at(score, by[at[hit]], gain[posting[hit]])
        return pa.table([told.column("q"), told.column("doc_id"), pa.array(score)], names=["q", "doc_id", "score"])

    return run


def _kth(rows: DataFrame, value: str, k: int, n: int) -> np.ndarray:
    """The k-th highest value of each item; 0 where there are fewer."""
    out = np.zeros(n, np.int64)
    nth = F.row_number().over(W.partitionBy("q").orderBy(F.desc(value)))
    for q, x in rows.select("q", value).withColumn("nth", nth).where(F.col("nth") == k).select("q", value).collect():
        out[q] = x
    return out


def _extremes(items: Items, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest threshold of the items that have each term."""
    if not len(items.owners):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    each = least[items.owners]
    return np.minimum.reduceat(each, items.bounds[:-1]), np.maximum.reduceat(each, items.bounds[:-1])


def _search_block(docs: DataFrame, texts: list[str | None], k: int, size: int) -> DataFrame:
    """(q, rank, doc_id, score) for the items of a block, q being their place in it."""
    context = docs.sparkSession.sparkContext
    items = Items.of(texts)
    n = len(texts)
    parts = max(size // TASK_BYTES, context.defaultParallelism)
    bucket = F.pmod(F.xxhash64("base"), F.lit(parts)).cast("int")

    scanned = docs.mapInArrow(_scan(items, size // LIST_BYTES + 1), _LIST)
    lists = cut(scanned.repartition(parts, "code", "salt").sortWithinPartitions("code"))
    docs_, words = lists.where("code < 0").agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    postings = lists.where("code >= 0")
    df = np.zeros(len(items.vocabulary), np.int64)
    for c, many in postings.groupBy("code").agg(F.sum(F.length("offs") / 4).cast("long")).collect():  # one row a term of the block
        df[c] = many
    scoring = Scoring.of(docs_, words, df)

    heads = postings.select("code", "base", "offs", "tf", "n").mapInArrow(_heads(scoring, k), "code int, doc long, impact long")
    nth = F.row_number().over(W.partitionBy("code").orderBy(F.desc("impact"), "doc"))
    heads = heads.withColumn("nth", nth).where(F.col("nth") <= k)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, doc, impact = (np.asarray(batch.column(c)) for c in ("code", "doc", "impact"))
            for posting, item in items.expanded(code, 0, n):
                yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(doc[posting]), pa.array((impact * scoring.weight[code])[posting])], names=["q", "doc", "gain"])

    sums = heads.select("code", "doc", "impact").mapInArrow(weighed, "q int, doc long, gain long").groupBy("q", "doc").agg(F.sum("gain").alias("low"))
    t1 = _kth(sums, "low", k, n)
    least = np.maximum(-(-t1 // np.maximum(items.sizes, 1)), 1)
    lowest, highest = _extremes(items, least)

    columns = lists.select("code", "base", "offs", "tf", "n", "ids")
    sent = columns.mapInArrow(_send(scoring, lambda code, gain: gain >= lowest[code]), _SENT)
    found = cut(sent.groupBy(bucket).applyInArrow(_bounds(items, scoring, t1, least, k), _CANDIDATE))
    t2 = np.maximum(np.maximum(t1, _kth(found, "low", k, n)), 1)
    bounds = docs.sparkSession.createDataFrame([(q, int(t)) for q, t in enumerate(t2)], "q int, t2 long")
    candidates = found.join(F.broadcast(bounds), "q").where("high >= t2").select(*_names(_CANDIDATE))

    rest = columns.where("code >= 0").mapInArrow(_send(scoring, lambda code, gain: (gain < highest[code]) & (gain > 0)), _SENT)
    both = candidates.select(*_names(_CANDIDATE), *[F.lit(None).cast(t).alias(c) for c, t in (("code", "int"), ("offs", "binary"), ("impact", "binary"))])
    both = both.unionByName(rest.drop("ids"), allowMissingColumns=True)
    exact = both.groupBy(bucket).applyInArrow(_exact(items, scoring, least), "q int, doc_id long, score long")
    best = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first()))
    return exact.where("score > 0").withColumn("rank", best).where(F.col("rank") <= k)


def ranked_search(documents: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 of each item."""
    spark = documents.sparkSession
    bounded_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    size = bytes_of(docs)
    for block in item_blocks(items, block_bytes)[1]:
        if block:
            names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q int, item_id {kind}")
            found = _search_block(docs, [t for _, t in block], k, size)
            out = out.unionByName(found.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"))
    return out


ORACLE_SQL = r"""
WITH i AS (SELECT DISTINCT item_id, text FROM benchmark),
t AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
p AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
s AS (
  SELECT item_id, text, p.r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM t JOIN p USING (term) JOIN w USING (term) JOIN n ON n.r = p.r CROSS JOIN c GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
