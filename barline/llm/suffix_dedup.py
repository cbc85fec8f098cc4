"""Exact-substring dedup with a difference cover, as in distributed suffix sorting (operator 6).

A difference cover D modulo v has, for any two positions i and j, a shift d < v with (i + d) mod v and
(j + d) mod v both in D.  So if a string of ``passage`` bytes stands at i and at j, the sampled
suffixes at i + d and j + d share ``passage - v + 1`` bytes at least.  The classic cover is {1, 2} of 3
and its tuples are triples; the covers used here are perfect difference sets, 12 of 133 for passages of
256 bytes, so that one position in 11 is sampled and its tuples are 124 bytes long.

1. Sampled tuples are sorted over the corpus, in buckets by hash; equal neighbours get one name, and
   a tuple whose name nobody shares is dropped: no repeat runs through it.
2. The names are refined: tuples of one name are sorted by what stands to either side, as far as a
   string of ``length`` bytes through the tuple can reach.  Where two agree in that too, every such
   string recurs.  This settles the inside of copies.  Where a name has different surroundings, one
   tuple of each goes on.
3. The suffixes that begin where a string of ``length`` bytes can hold one of those are sorted by their
   first ``length`` bytes, and equal neighbours in that order are the rest of the repeats.  As a repeat
   has a shared tuple in every v positions, suffixes with wider gaps between shared tuples are left out.
   No comparison needs more than ``length`` bytes, so recursion on names ends here.

``length`` decides what is removed.  ``passage``, which is no longer, decides what is noticed: n_shared is
the number of bytes in sampled tuples that also stand elsewhere, and it is above 0 in every document that
has a string of ``passage`` bytes which also starts anywhere else.  For shorter shared
strings it depends on how they lie to the sampling grid of their document.

Defined results: a null text is empty; a text shorter than ``length`` loses nothing; a copy of a row,
doc_id included, counts as another occurrence; an empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from . import repeats, textkit as tk

LENGTH = 400
PASSAGE = 256


def difference_set(p: int) -> tuple[int, np.ndarray]:
    """v = p * p + p + 1 and p + 1 residues whose differences are all of 1 .. v - 1, once each (Singer, 1938),
    for a prime p: the zeros of a linear recurrence of order 3 modulo p."""
    v = p * p + p + 1
    for a, b, c in product(range(p), range(p), range(1, p)):
        s = [0, 0, 1]
        while len(s) < v:
            s.append((a * s[-1] + b * s[-2] + c * s[-3]) % p)
        d = np.flatnonzero(np.array(s) == 0)
        if len(d) == p + 1 and len(np.unique((d[:, None] - d[None, :]) % v)) == v:
            return v, d
    raise ValueError(f"{p} is not a prime")


@cache
def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The longest period that leaves tuples of two fifths of the length; {0, 1} of 3 for short ones."""
    best = (3, np.array([0, 1]))
    for p in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31):
        if (length - (p * p + p + 1) + 1) * 5 >= length * 2:
            best = difference_set(p)
    return best


def sampled(offs: np.ndarray, v: int, cover: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions from which width bytes remain in their document, counted through the piece; the
    same as numbers of samples, and the number of each document's first sample."""
    size = np.diff(offs)
    rounds = (size + v - 1) // v
    first = np.cumsum(rounds) - rounds
    turn = np.arange(int(rounds.sum())) - np.repeat(first, rounds)
    at = ((np.repeat(offs[:-1], rounds) + turn * v)[:, None] + cover[None, :]).ravel()
    end = np.repeat(np.repeat(offs[1:], rounds), len(cover))
    fits = np.flatnonzero(at + width <= end)
    return at[fits], fits, first * len(cover)


def sample_places(numbers: np.ndarray, v: int, cover: np.ndarray) -> np.ndarray:
    """Positions in a document of its samples with these numbers."""
    return numbers // len(cover) * v + cover[numbers % len(cover)]


def _samples(col: pa.Array, piece: tk.Piece, v: int, cover: np.ndarray, shift: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Reported samples of a piece: place, number through the piece, what stands below the number by shift
    bits, and each document's first number."""
    size = np.diff(piece.offs)
    rounds = (size + v - 1) // v
    first = (np.cumsum(rounds) - rounds) * len(cover)
    at, numbers, status = [], [], []
    for d, k in enumerate(range(piece.rows.start, piece.rows.stop)):
        x = repeats.positions(col, k)
        if len(x):
            n = x >> shift
            at.append(sample_places(n, v, cover) + piece.offs[d])
            numbers.append(n + first[d])
            status.append(x & ((1 << shift) - 1))
    none = [np.zeros(0, np.int64)]
    return *(np.concatenate(x or none) for x in (at, numbers, status)), first


_CONTEXT = "bucket int, keys binary, contexts binary, gaps binary, rids binary, base binary"
#: What is said of a tuple, in the lowest STATUS bits below its number.
SETTLED, OPEN, STATUS = 1, 2, 2


def _send_contexts(docs: DataFrame, v: int, cover: np.ndarray, width: int, reach: int, buckets: int) -> DataFrame:
    """Tuples with shared names: name, surroundings, place. One entry for each different pair in a piece;
    a pair that stands twice in the piece is settled there."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, rows = tk.i64(batch.column("rid")), []
            for n, piece in enumerate(tk.pieces(batch.column("text"), 1 << 20)):
                offs, rids = piece.offs, rid[piece.rows]
                found, number, _, first = _samples(batch.column("at"), piece, v, cover)
                if not len(found):
                    continue
                doc = np.searchsorted(offs, found, "right") - 1
                low, high = np.maximum(found - reach, offs[doc]), np.minimum(found + width + reach, offs[doc + 1])
                keys = tk.span_hash(piece.data, found, found + width)
                context = tk.mix(tk.span_hash(piece.data, low, high) + (found - low).astype(tk.U64))
                by = np.lexsort((context, keys))
                new = np.ones(len(by), bool)
                new[1:] = (keys[by][1:] != keys[by][:-1]) | (context[by][1:] != context[by][:-1])
                again = ~new
                again[:-1] |= ~new[1:]
                twins = np.sort(by[again])
                if len(twins):
                    rows.append((int(n + rid[0]) % buckets, b"", b"", *repeats.placed(number[twins], rids, first)[:3]))
                sent = np.sort(by[new])
                to = ((keys[sent] >> tk.U64(32)) * tk.U64(buckets) >> tk.U64(32)).astype(np.int64)
                o = np.argsort(to, kind="stable")
                sent, to = sent[o], to[o]
                cuts = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    some = sent[a:b]
                    rows.append((int(to[a]), keys[some].tobytes(), context[some].tobytes(), *repeats.placed(number[some], rids, first)[:3]))
            if rows:
                kinds = (pa.int32(), *[pa.binary()] * 5)
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in _CONTEXT.split(", ")])

    return docs.mapInArrow(send, _CONTEXT)


def _refine(sent: DataFrame, homes: int) -> DataFrame:
    """(rid, at) of all tuples whose name is shared, with at = number * 4 + SETTLED and OPEN."""

    def answer(table: pa.Table) -> pa.Table:
        keys, contexts, rids, marks, twins = [], [], [], [], []
        for row in table.to_pylist():
            _, rid, pos = repeats.places(row["gaps"], row["rids"], row["base"])
            pos = pos * np.uint32(1 << STATUS)
            if row["keys"]:
                keys.append(np.frombuffer(row["keys"], tk.U64))
                contexts.append(np.frombuffer(row["contexts"], tk.U64))
                rids.append(rid)
                marks.append(pos)
            else:
                twins.append((rid, pos + np.uint32(SETTLED)))
        if keys:
            key, context, rid, mark = map(np.concatenate, (keys, contexts, rids, marks))
            by = np.lexsort((context, key))
            key, context = key[by], context[by]
            new_key = np.append(True, key[1:] != key[:-1])
            new = new_key | np.append(True, context[1:] != context[:-1])
            settled = ~new
            settled[:-1] |= ~new[1:]
            # Names with more than one kind of surroundings: the first tuple of each kind goes on.
            kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))
            goes_on = new & (kinds[np.cumsum(new_key) - 1] > 1)
            told = settled | goes_on
            status = (settled * SETTLED + goes_on * OPEN).astype(np.uint32)
            twins.append((rid[by[told]], mark[by[told]] + status[told]))
        if not twins:
            return repeats._REPLY.empty_table()
        return repeats._packed(np.concatenate([r for r, _ in twins]), np.concatenate([p for _, p in twins]), homes)

    return repeats.by_document(sent.groupBy("bucket").applyInArrow(answer, repeats.REPLY))


def _through(found: np.ndarray, offs: np.ndarray, reach: int, length: int) -> np.ndarray:
    """Starts of the strings of ``length`` bytes that hold one of the tuples found."""
    if not len(found):
        return found
    doc = np.searchsorted(offs, found, "right") - 1
    low = np.maximum(found - reach, offs[doc])
    hit = np.flatnonzero(tk.cover(int(offs[-1]), low, found - low + 1))
    return hit[hit + length <= offs[np.searchsorted(offs, hit, "right")]]


def _without_gaps(starts: np.ndarray, shared: np.ndarray, offs: np.ndarray, v: int, slack: int) -> np.ndarray:
    """Those of the starts p for which every v positions from p to p + slack + v - 1 have a shared tuple."""
    if not len(starts) or not slack:
        return starts
    doc = np.searchsorted(offs, shared, "right") - 1
    low = np.maximum(shared - (v - 1), offs[doc])
    near = np.append(0, np.cumsum(tk.cover(int(offs[-1]), low, shared - low + 1)))
    return starts[near[starts + slack + 1] - near[starts] == slack + 1]


def repeated_strings(docs: DataFrame, length: int, v: int, cover: np.ndarray, width: int) -> tuple[DataFrame, DataFrame]:
    """(rid, at) of the shared tuples with their status, and (rid, at) of the starts found last."""
    buckets = repeats.buckets_for(docs)
    reach = length - width

    def name_tuples(batch: pa.RecordBatch) -> Iterator[tuple]:
        rid = tk.i64(batch.column("rid"))
        for k, piece in enumerate(tk.pieces(batch.column("text"))):
            at, numbers, first = sampled(piece.offs, v, cover, width)
            keys = tk.span_hash(piece.data, at, at + width)
            yield from repeats.entries(keys, numbers, rid[piece.rows], first, None, buckets, "any", True, int(rid[0]) + k)

    def name_strings(batch: pa.RecordBatch) -> Iterator[tuple]:
        rid = tk.i64(batch.column("rid"))
        for k, piece in enumerate(tk.pieces(batch.column("text"), 1 << 20)):
            shared, _, status, _ = _samples(batch.column("at"), piece, v, cover, STATUS)
            at = _through(shared[status & OPEN > 0], piece.offs, reach, length)
            at = _without_gaps(at, shared, piece.offs, v, reach - (v - 1))
            keys = tk.span_hash(piece.data, at, at + length)
            yield from repeats.entries(keys, at, rid[piece.rows], piece.offs[:-1], None, buckets, "any", False, int(rid[0]) + k)

    # All joins read all columns of docs, so that one shuffle of the texts serves them all.
    found = repeats.find(docs.select("rid", "text"), name_tuples, "any", True, buckets)
    shared = _refine(_send_contexts(docs.join(found, "rid"), v, cover, width, reach, buckets), max(buckets // 2, 4))
    return shared, repeats.find(docs.join(shared, "rid"), name_strings, "any", False, buckets)


def remove_repeats(documents: DataFrame, length: int = LENGTH, passage: int = PASSAGE, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared) of each document.

    Removes each byte covered by a string of ``length`` bytes that also starts anywhere else.
    with_text adds kept_text, and ``row``, a struct of the document's other columns; where a removed
    span cuts a character, its other bytes are left out of kept_text too, while the digest is of the
    bytes.
    """
    carried = ("row",) if with_text else ()
    docs = repeats.with_row_id(documents, with_text).select("rid", "doc_id", "text", *carried)
    v, cover = cover_for(min(length, passage))
    width = min(length, passage) - v + 1
    shared, strings = repeated_strings(docs, length, v, cover, width)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, at, tuples = batch.column("text"), batch.column("at"), batch.column("tuples")
            size, gone, spans, digest, noticed, kept = [], [], [], [], [], []
            for k in range(len(text)):
                left = (text[k].as_py() or "").encode()
                size.append(len(left))
                starts, mark = repeats.positions(at, k), repeats.positions(tuples, k)
                noticed.append(0)
                if len(mark):
                    whole, place = np.array([0, len(left)]), sample_places(mark >> STATUS, v, cover)
                    noticed[-1] = int(tk.cover(len(left), place, width).sum())
                    starts = np.concatenate([starts, _through(place[mark & SETTLED > 0], whole, length - width, length)])
                if len(starts):
                    out = tk.cover(len(left), starts, length)
                    gone.append(int(out.sum()))
                    spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                    left = np.frombuffer(left, np.uint8)[~out].tobytes()
                else:
                    gone.append(0)
                    spans.append(0)
                digest.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left.decode(errors="ignore"))
            cols = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (size, gone, spans)), pa.array(digest, pa.string()), pa.array(noticed, pa.int64())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"]
            if with_text:
                cols += [pa.array(kept, pa.string()), batch.column("row")]
                names += ["kept_text", "row"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    shape = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long" + ", kept_text string" * with_text)
    for name in carried:
        shape.add(docs.schema[name])
    found = docs.join(shared.withColumnRenamed("at", "tuples"), "rid", "left").join(strings, "rid", "left")
    return found.select("doc_id", "text", "tuples", "at", *carried).mapInArrow(strip, shape)
