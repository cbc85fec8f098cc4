"""Vectorised text kernels that the operators of this subpackage share.

Texts arrive as Arrow string columns.  All work is done on the UTF-8 bytes of many documents at
once, in pieces of bounded size, so that no Python code runs per word or per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE_BYTES = 2 << 20
#: Elements that are mixed at once, so that they stay in a core's cache. Any choice is right.
_BLOCK = 1 << 15
_CHUNK = 8  # bytes in an element
_LEFT, _SIZE = U64(0x9E6C63D0676A9A9B), U64(0xD1342543DE82EF95)
_ONLY = np.array([(1 << 8 * k) - 1 for k in range(_CHUNK + 1)], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every output bit depends on every input bit."""
    return _mix_here(np.array(x, U64))


def _mix_here(x: np.ndarray) -> np.ndarray:
    for at in range(0, len(x), _BLOCK):
        part = x[at : at + _BLOCK]
        part ^= part >> U64(30)
        part *= U64(0xBF58476D1CE4E5B9)
        part ^= part >> U64(27)
        part *= U64(0x94D049BB133111EB)
        part ^= part >> U64(31)
    return x


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a, b. It is mixed at each level, so no sum of powers is left whose terms could cancel."""
    out = a * _LEFT
    out += b
    return _mix_here(out)


def _windows(base: np.ndarray, step: int, at: np.ndarray, width: int) -> np.ndarray:
    """Names of the windows of width = step * 2**k that start at ``at``: that of a half and the other half.
    All windows are named where most are asked for, else those that are needed."""
    if width == step:
        return base[at]
    if 2 * len(at) > len(base):
        named, size = base, step
        while size < width:
            named, size = _pair(named[: len(named) - size], named[size:]), size * 2
        return named[at]
    half = width // 2
    both = _windows(base, step, np.concatenate([at, at + half]), half)
    return _pair(both[: len(at)], both[len(at) :])


def _spans(base: np.ndarray, step: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of spans of at least ``step``: two windows, at the start and at the end, cover each; their
    width is the largest step * 2**k below the size, so spans of one size are covered alike."""
    out = np.empty(len(start), U64)
    level = np.ceil(np.log2(np.maximum(size / step, 1))).astype(np.int64)
    for k in np.unique(level).tolist():
        some = np.flatnonzero(level == k) if k or level.any() else slice(None)
        at = start[some]
        if k == 0:
            out[some] = base[at]
            continue
        width = step << (k - 1)
        both = _windows(base, step, np.concatenate([at, at + size[some] - width]), width)
        out[some] = _pair(both[: len(at)], both[len(at) :])
    out += size.astype(U64) * _SIZE
    return _mix_here(out)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of data[start:end], the same wherever equal bytes stand; the length counts too."""
    padded = np.zeros(len(data) + _CHUNK, np.uint8)
    padded[: len(data)] = data
    loads = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)).astype(U64)
    size = end - start
    short = size <= _CHUNK
    if not short.any():
        return _spans(loads[:-1], _CHUNK, start, size)
    out = np.empty(len(start), U64)
    few = np.flatnonzero(short)
    out[few] = _mix_here((loads[start[few]] & _ONLY[size[few]]) + size[few].astype(U64) * _SIZE)
    more = np.flatnonzero(~short)
    if len(more):
        out[more] = _spans(loads[:-1], _CHUNK, start[more], size[more])
    return out


@dataclass
class Piece:
    """Some consecutive documents of a batch: bytes, offsets, and the batch rows they came from."""

    data: np.ndarray
    offs: np.ndarray
    rows: slice

    @property
    def n(self) -> int:
        return len(self.offs) - 1


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column without a copy where possible; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, ob, db = col.buffers()
    kind = np.int64 if wide else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(ob, kind, len(col) + 1, col.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(db, np.uint8) if db is not None and db.size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def pieces(col: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a text column at document boundaries; a longer document is a piece of its own."""
    data, offs = string_buffers(col)
    at, n = 0, len(offs) - 1
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield Piece(data[offs[at] : offs[to]], offs[at : to + 1] - offs[at], slice(at, to))
        at = to


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
NOT_SPACE = ~SPACE
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
ALPHA = byte_class((0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """Words of a piece in order; bounds[d]:bounds[d + 1] are those of document d."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def find_words(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes; a run never crosses from one document into the next."""
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offs[:-1] < offs[1:]
    heads, tails = offs[:-1][full], offs[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, offs))


def terms(piece: Piece, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(document, term, occurrences) of each different term of each document, ordered by both; the terms, A-Z
    lower-cased; and how many words each document has."""
    data = LOWER[piece.data]
    words = find_words(data, piece.offs, is_word)
    ends = np.append(0, np.cumsum(words.end - words.start)).astype(np.int32)
    body = np.ascontiguousarray(data[is_word[data]])
    each = pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(body)]).dictionary_encode()
    n = max(len(each.dictionary), 1)
    pair, count = np.unique(doc_of(words.bounds) * n + np.asarray(each.indices), return_counts=True)
    return *np.divmod(pair, n), count, each.dictionary, np.diff(words.bounds)


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    return span_hash(data, words.start, words.end)


def seq_hash(names: np.ndarray, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Names of the sequences names[at] .. names[at + length - 1]; a length is 1 or more."""
    return _spans(names, 1, at, np.broadcast_to(np.asarray(length, np.int64), at.shape))


def doc_of(bounds: np.ndarray) -> np.ndarray:
    """The document of each item, given where each document's items begin."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums_of(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of each document's values; 0 where it has none."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offs[1:]] - total[offs[:-1]]


def cover(n: int, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of n items lie in a span start .. start + length - 1."""
    change = np.bincount(start, minlength=n + 1).astype(np.int64) - np.bincount(start + length, minlength=n + 1).astype(np.int64)
    return np.cumsum(change)[:n] > 0


def i64(col: pa.Array, null: int = -(2**63)) -> np.ndarray:
    """An integer column; null sorts before all."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.cast(pa.int64()).fill_null(null))


def binary_column(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())


def ragged_binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose row k is values[bounds[k]:bounds[k + 1]]."""
    size = values.dtype.itemsize
    offs = ((bounds - bounds[0]) * size).astype(np.int32)
    body = np.ascontiguousarray(values[bounds[0] : bounds[-1]])
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offs), pa.py_buffer(body)])
