"""Quality classifier: a byte-level convolutional network in numpy (operator 7).

A text is cut into blocks of ``BLOCK`` bytes; two neighbouring blocks make a chunk, so chunks overlap
by half and cover the whole document.  Learned filters look at ``WIDTH`` embedded bytes at every second
place; their highest response in each chunk is kept, and a document's mean and highest chunk responses
are combined by one logistic unit.

Training uses a bounded sample: at most ``per_class`` labelled documents of each class with ``most_bytes``
of text, chosen by a hash of doc_id, from rows that are not held out.  Scoring covers every row and the whole text.

Defined results: null and empty texts are one blank block and get a score like any other; without
labels every score is 0.5; a document with several labels trains with the smallest; repeated rows get
equal rows; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame, functions as F

from . import textkit as tk
from .langid import SAMPLE_BYTES, bounded_sample, held_out, within_bytes
from .shared import bounded_batches

BLOCK, WIDTH, STRIDE, EMBED, FILTERS = 128, 6, 2, 8, 24
PLACES = BLOCK // STRIDE
PER_CLASS = 1200
_SPAN = BLOCK + WIDTH - STRIDE


def blocks(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each block with the few that its last filters see, and each document's first block.

    Behind the end of a document are blanks, so that no filter sees another document.
    """
    size = np.diff(offs)
    count = np.maximum((size + BLOCK - 1) // BLOCK, 1)
    first = np.concatenate(([0], np.cumsum(count)))
    row = np.arange(first[-1])
    doc = tk.doc_of(first)
    at = offs[doc] + (row - first[doc]) * BLOCK
    index = at[:, None] + np.arange(_SPAN)[None, :]
    inside = index < offs[doc + 1][:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(index, len(data))], np.uint8(0)), first


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray
    out: np.ndarray  # 2 * FILTERS + 1

    @staticmethod
    def fresh(seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        return Network(draw(256, EMBED, s=0.5), draw(WIDTH * EMBED, FILTERS, s=(WIDTH * EMBED) ** -0.5), np.zeros(FILTERS, np.float32), draw(2 * FILTERS + 1, s=0.1))

    def respond(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest response of each filter in each block, and where it was."""
        x = self.embed[rows]
        b, _, e = x.shape
        s = x.strides
        seen = as_strided(x, (b, PLACES, WIDTH * EMBED), (s[0], s[1] * STRIDE, s[2]))
        r = seen.reshape(b * PLACES, WIDTH * EMBED) @ self.filters
        r = r.reshape(b, PLACES, FILTERS)
        return np.maximum(r.max(1) + self.bias, 0), r

    def pool(self, top: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk responses, and the mean and the highest of each document."""
        chunk = top.copy()
        chunk[:-1] = np.maximum(top[:-1], top[1:])
        last = first[1:] - 1
        chunk[last] = top[last]
        mean = np.add.reduceat(chunk, first[:-1]) / np.diff(first)[:, None]
        return chunk, mean, np.maximum.reduceat(chunk, first[:-1])

    def score(self, rows: np.ndarray, first: np.ndarray, step: int = 1024) -> np.ndarray:
        top = np.concatenate([self.respond(rows[k : k + step])[0] for k in range(0, len(rows), step)])
        _, mean, high = self.pool(top, first)
        z = mean @ self.out[:FILTERS] + high @ self.out[FILTERS:-1] + self.out[-1]
        # How a matrix product rounds depends on its size; six decimals are the same for equal texts.
        return np.round(1 / (1 + np.exp(-z.astype(np.float64))), 6)


def _step(net: Network, rows: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted log loss for a few documents."""
    top, r = net.respond(rows)
    where = r.argmax(1)  # block x filter
    chunk, mean, high = net.pool(top, first)
    z = mean @ net.out[:FILTERS] + high @ net.out[FILTERS:-1] + net.out[-1]
    dz = (1 / (1 + np.exp(-z)) - y) * weight
    d_out = np.concatenate([mean.T @ dz, high.T @ dz, [dz.sum()]])
    doc = tk.doc_of(first)
    # Back through the means and the highest chunks, to the block that each chunk's response came from.
    d_chunk = (dz / np.diff(first))[doc, None] * net.out[None, :FILTERS]
    is_high = chunk == high[doc]
    share = np.add.reduceat(is_high.astype(np.float32), first[:-1])[doc]
    d_chunk = d_chunk + is_high / share * dz[doc, None] * net.out[None, FILTERS:-1]
    right = np.zeros(chunk.shape, bool)
    right[:-1] = top[1:] > top[:-1]
    right[first[1:] - 1] = False
    d_top = np.where(right, 0, d_chunk)
    d_top[1:] += np.where(right[:-1], d_chunk[:-1], 0)
    d_top = np.where(top > 0, d_top, 0).astype(np.float32)
    d_filters, d_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
    at = where * STRIDE
    for k in range(WIDTH):
        seen = rows[np.arange(len(rows))[:, None], at + k]  # byte under each filter's highest place
        for f in range(FILTERS):
            by_byte = np.bincount(seen[:, f], weights=d_top[:, f], minlength=256).astype(np.float32)
            d_filters[k * EMBED : (k + 1) * EMBED, f] = net.embed.T @ by_byte
            d_embed += np.outer(by_byte, net.filters[k * EMBED : (k + 1) * EMBED, f])
    return [d_embed, d_filters, d_top.sum(0), d_out.astype(np.float32)]


def train(texts: list[str], labels: list[int], epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Network | None:
    """Adam on the log loss; both classes weigh the same in total."""
    if not texts:
        return None
    net, rng = Network.fresh(), np.random.default_rng(seed)
    data, offs = tk.string_buffers(pa.array(texts, pa.large_string()))
    rows, first = blocks(data, offs)
    y = np.array(labels, np.float32)
    share = np.where(y > 0.5, 0.5 / max((y > 0.5).mean(), 1e-6), 0.5 / max((y < 0.5).mean(), 1e-6)).astype(np.float32)
    params = [net.embed, net.filters, net.bias, net.out]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), batch):
            some = order[k : k + batch]
            pick = np.concatenate([np.arange(first[d], first[d + 1]) for d in some])
            begin = np.concatenate(([0], np.cumsum(first[some + 1] - first[some])))
            grads = _step(net, rows[pick], begin, y[some], share[some] / len(some))
            t += 1
            now = rate * (0.3 if epoch >= epochs * 2 // 3 else 1)
            for p, g, a, b in zip(params, grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= now * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    return net


def training_rows(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """The bounded sample: (text, quality) of up to per_class labelled documents of each class; of rows that
    share a doc_id one is taken, the one with the least text."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(~held_out(F.col("doc_id"), 3, 1)).join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = bounded_sample(known, "quality", per_class, ("doc_id",), 2)
    rows = documents.select("doc_id", "text").join(F.broadcast(picked.limit(per_class * 2)), "doc_id")
    rows = within_bytes(rows.groupBy("doc_id", "quality", "sample_nth").agg(F.min("text").alias("text")), "quality", most_bytes)
    return sorted((r["text"] or "", int(r["quality"])) for r in rows.select("text", "quality").collect())


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network | None:
    rows = training_rows(documents, labels, per_class)
    return train([t for t, _ in rows], [q for _, q in rows])


def score_documents(documents: DataFrame, net: Network | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and score of each document."""
    bounded_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(net)
    shape = documents.select(*keep).schema.add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = []
            for piece in tk.pieces(batch.column("quality_text"), 512 << 10):
                for at in range(0, piece.n, 2048):  # an empty document takes a block too
                    to = min(at + 2048, piece.n)
                    if model is None:
                        out.append(np.full(to - at, 0.5))
                        continue
                    offs = piece.offs[at : to + 1]
                    out.append(model.score(*blocks(piece.data[offs[0] : offs[-1]], offs - offs[0])))
            cols = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate(out) if out else np.zeros(0))], names=[*keep, "score"])

    return documents.select(*keep, F.col("text").alias("quality_text")).mapInArrow(score, shape)


def quality_scores(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document, by a network learnt from labelled rows that
    are not held out."""
    marked = documents.select("doc_id", "text", held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    scored = score_documents(marked, fit(documents, labels, per_class), ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
