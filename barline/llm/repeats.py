"""Which keyed positions of a corpus recur: the shuffle that several operators have in common.

A map task turns a piece of text into (key, position) entries.  It settles what recurs inside the
piece itself and sends one entry for each different key, so a line that stands in a third of all
documents costs one entry for each piece.  Entries are dealt to buckets by the upper bits of the
key, as packed arrays.  The number of buckets follows the size of the input, so a bucket holds a
bounded number of entries at any scale.  A bucket sorts its keys and answers with the positions that
recur, packed by home; a home is a group of documents by the hash of their rid.  Each home then puts
together one row for each of its documents.

``any``: a position is reported if its key stands at another position too.
``later``: a position is reported if its key also stands at a smaller (order, position).

With ``narrow`` entries only 32 bits of a key besides its bucket travel; a bucket of a few million
entries then reports about one in a thousand of the unique keys too, which is right for a filter
ahead of an exact pass and for nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import textkit as tk
from .shared import bounded_batches, bytes_of

BUCKET_BYTES = 12 << 20
ENTRY = "bucket int, keys binary, gaps binary, rids binary, base binary, ords binary"
REPLY = "home int, rids binary, counts binary, pos binary"
FOUND = "rid long, at binary"
_ENTRY = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("gaps", pa.binary()), ("rids", pa.binary()), ("base", pa.binary()), ("ords", pa.binary())])
_REPLY = pa.schema([("home", pa.int32()), ("rids", pa.binary()), ("counts", pa.binary()), ("pos", pa.binary())])
_FOUND = pa.schema([("rid", pa.int64()), ("at", pa.binary())])


def buckets_for(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    return int(min(max(bytes_of(docs) // bucket_bytes, 8), 1 << 22))


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in a byte each, and where each ends; 255 says that 255 and the next byte add up."""
    more, last = np.divmod(numbers, 255)
    ends = np.cumsum(more + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = last
    return out, ends


def pack_gaps(at: np.ndarray) -> bytes:
    """Ascending numbers as the gaps between them."""
    return pack(np.diff(at, prepend=0))[0].tobytes()


def unpack_gaps(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    return np.cumsum(raw, dtype=np.int64)[raw != 255]


def _gaps_by_document(pos: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gaps inside each document, packed, with the end of each entry; docs has the first entry of each."""
    gaps = np.diff(pos.astype(np.int64), prepend=0)
    gaps[docs] = pos[docs]
    packed, ends = pack(gaps)
    return packed, np.append(0, ends)


def placed(at: np.ndarray, rids: np.ndarray, base: np.ndarray) -> tuple[bytes, bytes, bytes, np.ndarray]:
    """Packed positions and the documents they are in. at ascends and counts from the piece's start."""
    used = np.unique(np.searchsorted(base, at, "right") - 1)
    return pack_gaps(at), rids[used].tobytes(), base[used].astype(np.uint32).tobytes(), used


def places(gaps: bytes, rids: bytes, base: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the document, its rid, position in it) of each entry."""
    at, first = unpack_gaps(gaps), np.frombuffer(base, np.uint32).astype(np.int64)
    doc = np.searchsorted(first, at, "right") - 1
    return doc, np.frombuffer(rids, np.int64)[doc], (at - first[doc]).astype(np.uint32)


def _rows(bucket: int, keys: np.ndarray, at: np.ndarray, rids: np.ndarray, base: np.ndarray, ords: np.ndarray | None) -> tuple:
    gaps, rid, first, used = placed(at, rids, base)
    return bucket, keys.tobytes(), gaps, rid, first, b"" if ords is None else ords[used].tobytes()


def entries(keys: np.ndarray, at: np.ndarray, rids: np.ndarray, base: np.ndarray, ords: np.ndarray | None, buckets: int, mode: str, narrow: bool, salt: int) -> Iterator[tuple]:
    """Entry rows of one piece.

    at: position of each key, counted through the piece (base[document] + position in it), ascending.
    ords: what orders documents, for ``later``.
    """
    if not len(keys):
        return
    by = np.argsort(keys, kind="stable")
    sorted_keys = keys[by]
    new = np.ones(len(by), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    if mode == "later":
        # The least (order, position) of each key leads; the others are known to come later.
        doc = np.searchsorted(base, at, "right") - 1
        rank = np.unique(ords, return_inverse=True)[1]
        place = rank[doc].astype(np.int64) * (1 << 40) + (at - base[doc])
        group = np.cumsum(new) - 1
        multi = np.zeros(len(by), bool)
        multi[1:] |= ~new[1:]
        multi[:-1] |= ~new[1:]
        lead = np.ones(len(keys), bool)
        if multi.any():
            sub = np.flatnonzero(multi)
            own = rids[doc]
            o = sub[np.lexsort((own[by[sub]], place[by[sub]], group[sub]))]
            first = np.ones(len(o), bool)
            first[1:] = group[o][1:] != group[o][:-1]
            least = place[by[o]][np.maximum.accumulate(np.where(first, np.arange(len(o)), 0))]
            ahead = place[by[o]] == least
            # Texts of one doc_id may tie for the lead; each goes on, a repeated row once.
            new_rid = first.copy()
            new_rid[1:] |= own[by[o]][1:] != own[by[o]][:-1]
            lead[by[o]] = False
            lead[by[o[ahead & new_rid]]] = True
            known = by[o[~ahead]]
        else:
            known = np.zeros(0, np.int64)
    else:
        lead = np.zeros(len(keys), bool)
        lead[by[new]] = True
        again = ~new
        again[:-1] |= ~new[1:]
        known = by[again]
    if len(known):
        known = np.sort(known)
        yield _rows(int(salt % buckets), np.zeros(0, np.uint32), at[known], rids, base, ords)
    sent = np.flatnonzero(lead)
    to = ((keys[sent] >> tk.U64(32)) * tk.U64(buckets) >> tk.U64(32)).astype(np.int64)
    o = np.argsort(to, kind="stable")
    sent, to = sent[o], to[o]
    cuts = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        k = keys[sent[a:b]]
        yield _rows(int(to[a]), k.astype(np.uint32) if narrow else k, at[sent[a:b]], rids, base, ords)


def entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _ENTRY]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ENTRY, strict=True)], schema=_ENTRY)


def _answer(table: pa.Table, mode: str, narrow: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rid of each reported position, position in its document), by entry row."""
    kind = np.uint32 if narrow else tk.U64
    keys, parts, n = [], [], 0
    for row in table.to_pylist():
        kk = np.frombuffer(row["keys"], kind)
        doc, rid, pos = places(row["gaps"], row["rids"], row["base"])
        if not len(kk):  # settled inside the piece
            yield rid, pos
            continue
        keys.append(kk)
        parts.append((n, n + len(kk), rid, doc, pos, np.frombuffer(row["ords"], np.int64)))
        n += len(kk)
    if not n:
        return
    allk = np.concatenate(keys)
    by = np.argsort(allk, kind="stable")
    s = allk[by]
    again = np.zeros(n, bool)
    again[1:] = s[1:] == s[:-1]
    multi = again.copy()
    multi[:-1] |= again[1:]
    flag = np.zeros(n, bool)
    if mode == "any":
        flag[by[multi]] = True
    elif multi.any():
        sub = np.flatnonzero(multi)
        e = by[sub]
        which = np.searchsorted([p[1] for p in parts], e, "right")
        order, place = np.zeros(len(e), np.int64), np.zeros(len(e), np.int64)
        for x in np.unique(which):
            m = which == x
            a, _, _, doc, pos, ords = parts[x]
            order[m], place[m] = ords[doc[e[m] - a]], pos[e[m] - a]
        group = np.cumsum(~again)[sub]
        o = np.lexsort((place, order, group))
        first = np.ones(len(o), bool)
        first[1:] = group[o][1:] != group[o][:-1]
        lead = o[np.maximum.accumulate(np.where(first, np.arange(len(o)), 0))]
        late = (order[o] != order[lead]) | (place[o] != place[lead])
        flag[e[o[late]]] = True
    for a, b, rid, _, pos, _ in parts:
        hit = np.flatnonzero(flag[a:b])
        if len(hit):
            yield rid[hit], pos[hit]


def _packed(rid: np.ndarray, pos: np.ndarray, homes: int) -> pa.Table:
    """Reported positions as one row for each home."""
    if not len(rid):
        return _REPLY.empty_table()
    home = ((rid.view(tk.U64) >> tk.U64(32)) * tk.U64(homes) >> tk.U64(32)).astype(np.int64)
    by = np.lexsort((pos, rid, home))
    rid, pos, home = rid[by], pos[by], home[by]
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (pos[1:] != pos[:-1])
    rid, pos, home = rid[new], pos[new], home[new]
    head = np.flatnonzero(np.diff(home, prepend=-1))
    docs = np.flatnonzero(np.append(True, rid[1:] != rid[:-1]))
    counts = np.diff(docs, append=len(rid)).astype(np.uint32)
    cuts = np.append(np.searchsorted(docs, head), len(docs))
    packed, ends = _gaps_by_document(pos, docs)
    cols = [pa.array(home[head], pa.int32()), tk.ragged_binary(rid[docs], cuts), tk.ragged_binary(counts, cuts), tk.ragged_binary(packed, ends[np.append(head, len(rid))])]
    return pa.Table.from_arrays(cols, schema=_REPLY)


def replies(df: DataFrame, mode: str, narrow: bool, homes: int) -> DataFrame:
    """From entry rows to reply rows."""

    def answer(table: pa.Table) -> pa.Table:
        found = list(_answer(table, mode, narrow))
        if not found:
            return _REPLY.empty_table()
        return _packed(np.concatenate([r for r, _ in found]), np.concatenate([p for _, p in found]), homes)

    return df.groupBy("bucket").applyInArrow(answer, REPLY)


def by_document(packed: DataFrame) -> DataFrame:
    """(rid, at): the positions reported for a document, ascending, each once, as packed gaps."""

    def gather(table: pa.Table) -> pa.Table:
        whole = {c: b"".join(x.as_py() for x in table.column(c)) for c in ("rids", "counts", "pos")}
        counts = np.frombuffer(whole["counts"], np.uint32)
        rid = np.repeat(np.frombuffer(whole["rids"], np.int64), counts)
        total = np.append(0, unpack_gaps(whole["pos"]))
        before = total[np.cumsum(counts) - counts]
        pos = total[1:] - np.repeat(before, counts)
        by = np.lexsort((pos, rid))
        rid, pos = rid[by], pos[by]
        new = np.ones(len(rid), bool)
        new[1:] = (rid[1:] != rid[:-1]) | (pos[1:] != pos[:-1])
        rid, pos = rid[new], pos[new]
        docs = np.flatnonzero(np.append(True, rid[1:] != rid[:-1]))
        gaps, ends = _gaps_by_document(pos, docs)
        return pa.Table.from_arrays([pa.array(rid[docs]), tk.ragged_binary(gaps, ends[np.append(docs, len(rid))])], schema=_FOUND)

    return packed.groupBy("home").applyInArrow(gather, FOUND)


def reported(at: str) -> Column:
    """At least how many positions a packed column holds: its bytes but for fillers of long gaps, of which
    there are few.  Counting a filler keeps a row that might go, and never drops one."""
    return F.length(at)


def positions(col: pa.Array, k: int) -> np.ndarray:
    """The positions of row k."""
    x = col[k].as_py()
    return unpack_gaps(x) if x else np.zeros(0, np.int64)


def flat_positions(col: pa.Array, rows: slice, base: np.ndarray, place: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> np.ndarray:
    """Positions of some rows, each counted from base of its document; place turns what is reported into
    positions."""
    out = [place(positions(col, k)) + base[i] for i, k in enumerate(range(rows.start, rows.stop))]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def find(docs: DataFrame, keyed: Callable[[pa.RecordBatch], Iterator[tuple]], mode: str, narrow: bool, buckets: int) -> DataFrame:
    """(rid, at) of the documents with reported positions. keyed yields entry rows for a batch."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(keyed(batch))
            if rows:
                yield entry_batch(rows)

    return by_document(replies(docs.mapInArrow(send, ENTRY), mode, narrow, max(buckets // 2, 4)))


def with_row_id(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """rid names a row by its doc_id and text: rows that are equal in both share it. with_row adds ``row``,
    a struct of all columns but text."""
    bounded_batches(docs.sparkSession)
    rest = [F.struct(*[c for c in docs.columns if c != "text"]).alias("row")] if with_row else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("rid"), *rest)


def with_new_text(edited: DataFrame, columns: list[str]) -> DataFrame:
    """The documents again, from kept_text and row; n_chars follows the text."""

    def column(name: str) -> Column:
        if name == "text":
            return F.col("kept_text").alias("text")
        if name == "n_chars":
            return F.length("kept_text").cast(edited.schema["row"].dataType["n_chars"].dataType).alias("n_chars")
        return F.col("row")[name].alias(name)

    return edited.select(*map(column, columns))
