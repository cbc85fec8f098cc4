"""Substring dedup by recompression (operator 10).

Every text is parsed into a hierarchy of symbols, two rounds deep.  A round first names each maximal
run of one symbol, then names pairs: a bit of each name makes it a left or a right symbol, and a left
one is joined with a right one that follows.  A name is a hash of what it stands for, so it is the
same in all documents without a dictionary.  The parse at a place depends on a few symbols around it
only; equal substrings therefore get equal symbols inside, whatever stands around them.

``anchors`` are where a top symbol begins, or where a symbol of a run begins.  Any window of 20 words
holds an anchor at offset 9 or less that every other occurrence of the window has at the same offset
(see ``anchors``).  Two Spark rounds follow.  The first names the symbols' contents from each anchor,
11 words, over the whole corpus and reports the anchors whose name recurs.  The second names each
whole window that has such an anchor where it must have one, and reports those that also start
earlier.  What the first lets through by chance the second refuses.

Defined results: a null text has no words and keeps nothing; an empty table gives an empty result;
rows that repeat doc_id and text are one document and get equal rows; a null doc_id orders before all
others; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats, textkit as tk

WINDOW = 20
REACH = 9
_PAIR = tk.U64(0xA0761D6478BD642F)
_RUN = tk.U64(0xE7037ED1A0B428DB)


def _round(names: np.ndarray, start: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round over symbols (names, first word, document): the new symbols, and the starts of those
    symbols that stand in runs."""
    n = len(names)
    same = np.zeros(n + 1, bool)
    same[1:n] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
    in_run = start[same[:-1] | same[1:]]
    head = np.flatnonzero(~same[:-1])
    size = np.diff(head, append=n).astype(tk.U64)
    names = np.where(size > 1, tk.mix(names[head] ^ (size * _RUN)), names[head])
    start, doc = start[head], doc[head]
    right = (tk.mix(names + _RUN) >> tk.U64(63)).astype(bool)
    joined = np.zeros(len(names), bool)
    joined[1:] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
    opens = np.append(joined[1:], False)
    names = np.where(opens, tk.mix(names * _PAIR + np.append(names[1:], tk.U64(0))), names)
    return names[~joined], start[~joined], doc[~joined], in_run


def anchors(names: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words where a top symbol or a symbol of a run begins, ascending.

    In a window at p, if two neighbours among the words p .. p + 10 are equal, one at p + 9 or before
    is in a run.  If not, first-round symbols that begin at p + 2 or later are the same in every
    occurrence, as only the symbol of p and what is joined to it can depend on what stands before;
    each has one or two words.  Of the second, third and fourth of them, if two neighbours are equal
    they are in a run; if not, one of the third and fourth begins a second-round symbol, because one
    symbol cannot be both a right and a left one.  The fourth begins at p + 9 or before.
    """
    doc = tk.doc_of(bounds)
    start = np.arange(len(names))
    names, start, doc, runs = _round(names, start, doc)
    _, start, _, more = _round(names, start, doc)
    return np.unique(np.concatenate([start, runs, more]))


def _parsed(piece: tk.Piece) -> tuple[np.ndarray, tk.Words]:
    words = tk.find_words(piece.data, piece.offs, tk.NOT_SPACE)
    return tk.word_hashes(piece.data, words), words


def _fitting(at: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Those of the words at from which width words remain in their document."""
    return at[at + width <= bounds[np.searchsorted(bounds, at, "right")]] if len(at) else at


def candidates(found: np.ndarray, bounds: np.ndarray, window: int, reach: int) -> np.ndarray:
    """Starts of the windows that have a reported anchor at an offset up to reach."""
    if not len(found):
        return found
    home = bounds[np.searchsorted(bounds, found, "right") - 1]
    low = np.maximum(found - reach, home)
    hit = tk.cover(int(bounds[-1]), low, found - low + 1)
    return _fitting(np.flatnonzero(hit), bounds, window)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, at): starts of the windows of each document that also start earlier.

    docs has doc_id, text and rid.  A window must have 20 words or more: shorter ones need not hold
    a common anchor.
    """
    if window < WINDOW:
        raise ValueError("windows of fewer than 20 words need a shallower parse")
    tail = window - REACH
    buckets = repeats.buckets_for(docs)

    def name_anchors(batch: pa.RecordBatch) -> Iterator[tuple]:
        rid = tk.i64(batch.column("rid"))
        for k, piece in enumerate(tk.pieces(batch.column("text"))):
            names, words = _parsed(piece)
            at = _fitting(anchors(names, words.bounds), words.bounds, tail)
            keys = tk.seq_hash(names, at, tail)
            yield from repeats.entries(keys, at, rid[piece.rows], words.bounds[:-1], None, buckets, "any", True, int(rid[0]) + k)

    def name_windows(batch: pa.RecordBatch) -> Iterator[tuple]:
        rid, ords = tk.i64(batch.column("rid")), tk.i64(batch.column("doc_id"))
        for k, piece in enumerate(tk.pieces(batch.column("text"))):
            names, words = _parsed(piece)
            found = repeats.flat_positions(batch.column("at"), piece.rows, words.bounds[:-1])
            at = candidates(found, words.bounds, window, REACH)
            keys = tk.seq_hash(names, at, window)
            yield from repeats.entries(keys, at, rid[piece.rows], words.bounds[:-1], ords[piece.rows], buckets, "later", False, int(rid[0]) + k)

    hinted = repeats.find(docs.select("rid", "text"), name_anchors, "any", True, buckets)
    return repeats.find(docs.join(hinted, "rid").select("rid", "doc_id", "text", "at"), name_windows, "later", False, buckets)


def substring_dedup(documents: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each document, and kept_text if asked for.

    Removes every word that lies in a window of ``window`` words which also starts earlier in the
    corpus.  Windows are judged on the input.
    """
    docs = repeats.with_row_id(documents)
    repeated = repeated_windows(docs, window)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, at = batch.column("text"), batch.column("at")
            n, gone, digest, kept = [], [], [], []
            for k in range(len(text)):
                words = (text[k].as_py() or "").encode().split()
                n.append(len(words))
                starts = repeats.positions(at, k)
                if len(starts):
                    out = tk.cover(len(words), starts, window)
                    gone.append(int(out.sum()))
                    words = list(compress(words, ~out))
                else:
                    gone.append(0)
                left = b" ".join(words)
                digest.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left.decode())
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols.append(pa.array(kept, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    shape = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return docs.join(repeated, "rid", "left").select("doc_id", "text", "at").mapInArrow(strip, shape)
