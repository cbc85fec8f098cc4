"""Benchmark decontamination with an FM-index over each shard of training text (operator 5).

A shard is a piece of some megabytes of documents.  Its words become symbols of the benchmark's
vocabulary; as a window of benchmark words can only stand where all words are of that vocabulary,
maximal runs of such words that are long enough for the shortest window are all that is indexed.  The
index has the Burrows-Wheeler transform of these runs in a wavelet matrix, and a sample of suffix
positions.  All windows are searched backwards together, one word at a time; occurrences are located
by stepping to the nearest sampled position, and their spans are merged.

The benchmark is collected in blocks of ``BLOCK_BYTES`` at most, and a block is broadcast; a larger
benchmark is searched block by block, and what the blocks hit is merged for each document.  The driver
and a worker hold one block at a time.

Defined results: a null or empty text has no words and is clean; a benchmark row without words has no
window; one with a null item_id has windows that hit but no id to report; repeated rows get equal
rows; empty tables give empty or clean results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import repeats, textkit as tk
from .shared import cut, item_blocks

WINDOW = 10
BLOCK_BYTES = 16 << 20
SAMPLE = 8
#: Windows that are searched at once. Any choice is right.
PATTERNS = 1 << 17


class WaveletMatrix:
    """rank(c, i): how often symbol c stands in the first i places, for arrays of c and i."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        self.bits = max(int(sigma - 1).bit_length(), 1)
        for bit in range(self.bits - 1, -1, -1):
            on = (symbols >> bit) & 1
            ones = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(on, out=ones[1:])
            self.levels.append((bit, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[on == 0], symbols[on == 1]])
        self.first = np.searchsorted(symbols_order(symbols, self.bits), symbols_order(np.arange(sigma), self.bits))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            up = ones[i]
            i = np.where((c >> bit) & 1, zeros + up, i - up)
        return i - self.first[c]


def symbols_order(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Symbols with their bits reversed: the order in which the last level of the matrix holds them."""
    out = np.zeros_like(symbols)
    for bit in range(bits):
        out |= ((symbols >> bit) & 1) << (bits - 1 - bit)
    return out


class FMIndex:
    """Index of runs of symbols 1 .. sigma - 1, each run followed by a separator 0."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        breaks = text == 0
        # Separators differ from each other and come before all symbols, so all suffixes differ.
        rank = np.where(breaks, np.cumsum(breaks) - 1, int(breaks.sum()) + text)
        step = 1
        while True:
            order = np.lexsort((np.append(rank[step:], np.full(min(step, n), -1)), rank))
            second = np.append(rank[step:], np.full(min(step, n), -1))[order]
            new = np.ones(n, bool)
            new[1:] = (rank[order][1:] != rank[order][:-1]) | (second[1:] != second[:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
            step *= 2
        suffixes = order
        self.bwt = text[suffixes - 1]
        self.below = np.searchsorted(np.sort(text), np.arange(sigma + 1))
        self.tree = WaveletMatrix(self.bwt, sigma)
        # Rows whose position is a multiple of SAMPLE or begins a run, so no walk leaves its run.
        self.kept = (suffixes % SAMPLE == 0) | (self.bwt == 0)
        self.kept_rank = np.concatenate(([0], np.cumsum(self.kept)))
        self.sample = suffixes[self.kept]

    def search(self, text: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern text[start : start + length]."""
        low, high = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for at in range(0, len(start), PATTERNS):
            some = slice(at, at + PATTERNS)
            last = text[start[some] + lengths[some] - 1]
            low[some], high[some] = self.below[last], self.below[last + 1]
        live, k = np.flatnonzero(low < high), 1
        while len(live := live[(lengths[live] > k) & (low[live] < high[live])]):
            for at in range(0, len(live), PATTERNS):
                some = live[at : at + PATTERNS]
                c = text[start[some] + lengths[some] - 1 - k].astype(np.int64)
                low[some] = self.below[c] + self.tree.rank(c, low[some])
                high[some] = self.below[c] + self.tree.rank(c, high[some])
            k += 1
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        out = np.zeros(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(left):
            known = self.kept[at]
            out[left[known]] = self.sample[self.kept_rank[at[known]]] + steps
            left, at = left[~known], at[~known]
            c = self.bwt[at]
            at = self.below[c] + self.tree.rank(c, at)
            steps += 1
        return out


def exact_names(symbols: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the sequences of a length that start at ``at``, equal for equal sequences and for no others."""
    names, size = symbols.astype(np.int64), 1
    while 2 * size <= length:
        names = np.unique(names[: len(names) - size] * (len(symbols) + 1) + names[size:], return_inverse=True)[1]
        size *= 2
    return names[at] * (len(symbols) + 1) + names[at + length - size]


@dataclass
class Phrases:
    """The distinct windows of a block of benchmark items, as places in the items' words."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = place + 1
    text: np.ndarray  # symbols of all items, one after another
    start: np.ndarray  # where in text each window stands first
    lengths: np.ndarray
    bounds: np.ndarray  # owners[bounds[k]:bounds[k + 1]] are the items that have window k
    owners: np.ndarray
    ids: list[str]  # of the items, sorted

    @staticmethod
    def of(items: list[tuple[object, str | None]], window: int) -> Phrases:
        data, offs = tk.string_buffers(pa.array([t or "" for _, t in items], pa.large_string()))
        data = tk.LOWER[data]
        words = tk.find_words(data, offs, tk.ALNUM)
        names = tk.word_hashes(data, words)
        vocabulary = np.unique(names)
        text = (np.searchsorted(vocabulary, names) + 1).astype(np.int32)
        size = np.diff(words.bounds)
        ids = sorted({str(i) for i, _ in items if i is not None})
        place = {x: k for k, x in enumerate(ids)}
        rank = np.array([-1 if i is None else place[str(i)] for i, _ in items], np.int64)
        start, lengths, owners, bounds = [], [], [], [np.zeros(1, np.int64)]
        for length in np.unique(np.minimum(size, window)).tolist():
            some = np.flatnonzero(np.minimum(size, window) == length)
            count = size[some] - length + 1
            if not length:
                continue
            at = np.repeat(words.bounds[some], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            _, first, which = np.unique(exact_names(text, at, length), return_index=True, return_inverse=True)
            start.append(at[first].astype(np.int32))
            lengths.append(np.full(len(first), length, np.int32))
            pair = np.unique(which * (len(ids) + 1) + np.repeat(rank[some], count) + 1)
            pair = pair[pair % (len(ids) + 1) > 0]  # those without an id have no owner
            owners.append((pair % (len(ids) + 1) - 1).astype(np.int32))
            bounds.append(np.searchsorted(pair // (len(ids) + 1), np.arange(len(first)), "right") + bounds[-1][-1])
        none = [np.zeros(0, np.int32)]
        return Phrases(vocabulary, text, *(np.concatenate(x or none) for x in (start, lengths)), np.concatenate(bounds), np.concatenate(owners or none), ids)


def occurrences(piece: tk.Piece, phrases: Phrases) -> tuple[tk.Words, np.ndarray, np.ndarray]:
    """Words of the piece, and (first word, pattern) of each occurrence of a pattern."""
    none = np.zeros(0, np.int64)
    data = tk.LOWER[piece.data]
    words = tk.find_words(data, piece.offs, tk.ALNUM)
    if not len(words) or not len(phrases.lengths):
        return words, none, none
    names = tk.word_hashes(data, words)
    place = np.searchsorted(phrases.vocabulary, names)
    place[place == len(phrases.vocabulary)] = 0
    symbols = np.where(phrases.vocabulary[place] == names, place + 1, 0)
    in_run = symbols > 0
    first = in_run.copy()
    first[1:] &= ~in_run[:-1]
    heads = words.bounds[:-1][words.bounds[:-1] < words.bounds[1:]]
    first[heads] = in_run[heads]
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(words))
    ends = starts + np.add.reduceat(in_run.astype(np.int64), starts) if len(starts) else ends
    long = ends - starts >= phrases.lengths.min()
    starts, sizes = starts[long], (ends - starts)[long]
    if not len(starts):
        return words, none, none
    # Runs one after the other, a separator behind each; origin maps the text back to words.
    place = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[np.repeat(place, sizes) + inside] = symbols[np.repeat(starts, sizes) + inside]
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.text, phrases.start, phrases.lengths)
    counts = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), counts)
    rows = np.repeat(low, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    at = index.locate(rows)
    run = np.searchsorted(place, at, "right") - 1
    return words, starts[run] + at - place[run], which


SPANS = "rid long, pos binary, items array<string>"
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _hits(piece: tk.Piece, phrases: Phrases) -> tuple[tk.Words, np.ndarray, list[list[str]]]:
    """Words, which of them are hit, and the sorted ids of the items found in each document."""
    words, at, which = occurrences(piece, phrases)
    hit = tk.cover(len(words), at, phrases.lengths[which]) if len(at) else np.zeros(len(words), bool)
    items: list[list[str]] = [[] for _ in range(piece.n)]
    if len(at):
        doc = np.searchsorted(words.bounds, at, "right") - 1
        n = len(phrases.lengths)
        doc, which = np.divmod(np.unique(doc * n + which), n)
        many = phrases.bounds[which + 1] - phrases.bounds[which]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        owner = phrases.owners[np.repeat(phrases.bounds[which], many) + nth]
        known = max(len(phrases.ids), 1)
        for d, k in np.stack(np.divmod(np.unique(np.repeat(doc, many) * known + owner), known), 1).tolist():
            items[d].append(phrases.ids[k])
    return words, hit, items


def _digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _result(batch: pa.RecordBatch, n: list, hit: list, items: list[list[str]], texts: list[str] | None) -> pa.RecordBatch:
    cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(map(len, items), pa.int64()), pa.array(map(_digest, items), pa.string()), pa.array([h > 0 for h in hit], pa.bool_())]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    if texts is not None:
        cols += [pa.array(texts, pa.string()), batch.column("row")]
        names += ["kept_text", "row"]
    return pa.RecordBatch.from_arrays(cols, names=names)


def _cut(piece: tk.Piece, words: tk.Words, hit: np.ndarray) -> list[str]:
    """Texts without the spans of words that are hit; what stands between two words of a span goes too."""
    start, end = words.start[hit], words.end[hit].copy()
    joined = np.flatnonzero(np.diff(np.flatnonzero(hit)) == 1)
    same = np.searchsorted(piece.offs, start[joined], "right") == np.searchsorted(piece.offs, start[joined + 1], "right")
    end[joined[same]] = start[joined[same] + 1]
    out = tk.cover(len(piece.data), start, end - start)
    kept = piece.data[~out].tobytes()
    bounds = np.concatenate(([0], np.cumsum(~out)))[piece.offs]
    return [kept[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _shape(docs: DataFrame, with_text: bool) -> T.StructType:
    shape = T.StructType.fromDDL(RESULT)
    return shape.add("kept_text", "string").add(docs.schema["row"]) if with_text else shape


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each document.

    with_text adds kept_text, the text without the spans that are hit, and ``row``, a struct of the
    document's other columns.
    """
    context = documents.sparkSession.sparkContext
    docs = repeats.with_row_id(documents, with_text)
    n_blocks, blocks = item_blocks(benchmark, block_bytes)
    if n_blocks == 1:
        return _one_block(docs.drop("rid"), context.broadcast(Phrases.of(next(blocks), window)), with_text)
    found = None
    for items in blocks:
        phrases = context.broadcast(Phrases.of(items, window))

        def search(batches: Iterator[pa.RecordBatch], phrases=phrases) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rid = batch.column("rid")
                for piece in tk.pieces(batch.column("text")):
                    words, hit, items = _hits(piece, phrases.value)
                    some = [d for d in range(piece.n) if items[d] or hit[words.bounds[d] : words.bounds[d + 1]].any()]
                    pos = [np.flatnonzero(hit[words.bounds[d] : words.bounds[d + 1]]).astype(np.uint32).tobytes() for d in some]
                    ids = pa.array([rid[piece.rows.start + d].as_py() for d in some], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, tk.binary_column(pos), pa.array([items[d] for d in some], pa.list_(pa.string()))], names=["rid", "pos", "items"])

        # What a block hits is written, so that the block is in memory for its own search only.
        part = cut(docs.select("rid", "text").mapInArrow(search, SPANS))
        phrases.destroy()
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("rid").agg(F.collect_list("pos").alias("at"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hits, texts = [], [], []
            for piece in tk.pieces(batch.column("text")):
                words = tk.find_words(tk.LOWER[piece.data], piece.offs, tk.ALNUM)
                hit = np.zeros(len(words), bool)
                for d, k in enumerate(range(piece.rows.start, piece.rows.stop)):
                    at = np.frombuffer(b"".join(batch.column("at")[k].as_py() or []), np.uint32)
                    hit[words.bounds[d] + at.astype(np.int64)] = True
                n += np.diff(words.bounds).tolist()
                hits += tk.sums_of(hit, words.bounds).tolist()
                if with_text:
                    texts += _cut(piece, words, hit)
            items = [sorted(set(x.as_py() or [])) for x in batch.column("items")]
            yield _result(batch, n, hits, items, texts if with_text else None)

    return docs.join(merged, "rid", "left").drop("rid").mapInArrow(report, _shape(docs, with_text))


def _one_block(docs: DataFrame, phrases, with_text: bool) -> DataFrame:
    """Without a shuffle: each task searches its own shards and reports at once."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hits, items, texts = [], [], [], []
            for piece in tk.pieces(batch.column("text")):
                words, hit, found = _hits(piece, phrases.value)
                n += np.diff(words.bounds).tolist()
                hits += tk.sums_of(hit, words.bounds).tolist()
                items += found
                if with_text:
                    texts += _cut(piece, words, hit)
            yield _result(batch, n, hits, items, texts if with_text else None)

    return docs.mapInArrow(report, _shape(docs, with_text))
