"""Language identification in two steps (operator 8).

A one-versus-rest linear support vector machine for each language family picks the family; inside it,
one-versus-one machines for each pair of its languages vote.  Features are hashed byte trigrams of the
lower-cased text with everything but letters folded into one blank, as shares of all trigrams, so a
document's margin is the mean of its trigrams' weights, over the whole text.

Training uses a bounded sample: at most ``per_language`` documents of each language with ``most_bytes``
of text, chosen by a hash of doc_id and text; a row that is repeated counts once.  All languages are
learnt; features stay sparse and are made dense block by block.  Everything else covers all rows.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with nothing to learn
from, all is ``und``; with one language, all other texts get it; repeated rows get equal rows; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import textkit as tk
from .shared import bounded_batches

DIM = 4096
PER_LANGUAGE = 700
#: Bytes of the texts of one language, or one class, that a fit collects.
SAMPLE_BYTES = 8 << 20
#: Bytes of dense training features that are held; those beyond are made anew in each round. Any choice is right.
HELD = 64 << 20
UNKNOWN = "und"

# Families of ISO 639-1 codes; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "celtic": ("ga", "gd", "cy", "br"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
    "semitic": ("ar", "he", "mt", "am"),
}

# A letter, or a byte of a character that is not ASCII: 0 is everything else.
_FOLD = np.zeros(256, np.int64)
_FOLD[0x61:0x7B] = np.arange(1, 27)
_FOLD[0x41:0x5B] = np.arange(1, 27)
_FOLD[0x80:] = np.arange(27, 155)


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), lang)


def trigrams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The hashed trigram that begins at each byte; the last two bytes of a document see blanks."""
    code = np.zeros(len(data) + 2, np.int64)
    code[:-2] = _FOLD[data]
    second, third = code[1:-1].copy(), code[2:].copy()
    last = offs[1:][offs[1:] > offs[:-1]] - 1
    second[last] = third[last] = 0
    third[last[last > 0] - 1] = 0
    mixed = (code[:-2] * 160 + second) * 160 + third
    return ((mixed * 0x9E3779B1) >> 15) & (DIM - 1)


def features(piece: tk.Piece) -> np.ndarray:
    """Share of each hashed trigram in each document; zeros for an empty one."""
    at = tk.doc_of(piece.offs) * DIM + trigrams(piece.data, piece.offs)
    counts = np.bincount(at, minlength=piece.n * DIM).reshape(piece.n, DIM).astype(np.float32)
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def pieces(col: pa.Array, rows: int = 512) -> Iterator[tk.Piece]:
    """Pieces of few enough documents for a dense table of their trigrams."""
    for at in range(0, len(col), rows):
        for p in tk.pieces(col.slice(at, rows), 1 << 20):
            yield tk.Piece(p.data, p.offs, slice(p.rows.start + at, p.rows.stop + at))


@dataclass
class Block:
    """Features of some training rows of one family: columns and values of each row, and its language."""

    lang: np.ndarray
    size: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def dense(self) -> np.ndarray:
        x = np.zeros((len(self.size), DIM), np.float32)
        x[np.repeat(np.arange(len(self.size)), self.size), self.column] = self.value
        return x


def blocks_of(texts: list[str], lang: np.ndarray) -> list[Block]:
    out, at = [], 0
    for p in pieces(pa.array(texts, pa.large_string())):
        x = features(p)
        row, column = np.nonzero(x)
        out.append(Block(lang[at : at + p.n], np.bincount(row, minlength=p.n), column.astype(np.uint16), x[row, column]))
        at += p.n
    return out


def linear_svms(blocks: list[Block], signs: np.ndarray, strength: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights and bias, by column, of linear support vector machines with squared hinge loss; signs has
    1, -1 or 0, for none, of each language in each machine.

    Accelerated gradient descent on the scaled problem; classes weigh equally.
    """
    rows = np.bincount(np.concatenate([b.lang for b in blocks]), minlength=len(signs))
    share = np.zeros(signs.shape, np.float32)
    for side in (1, -1):
        share += (signs == side) * (0.5 / np.maximum(rows @ (signs == side), 1)).astype(np.float32)
    held = [b.dense() for b in blocks[: max(HELD // (512 * DIM * 4), 1)]]

    def through(v: np.ndarray, errors) -> np.ndarray:  # weights, then the bias, whose feature is always 1
        out = np.zeros_like(v)
        for k, b in enumerate(blocks):
            x = held[k] if k < len(held) else b.dense()
            e = errors(x @ v[:-1] + v[-1], share[b.lang], signs[b.lang])
            out[:-1] += x.T @ e
            out[-1] += e.sum(0)
        return out

    v = np.ones((DIM + 1, signs.shape[1]), np.float32)
    for _ in range(8):  # largest curvature, by the power method
        v = through(v, lambda m, share, _: share * m)
        v /= np.linalg.norm(v, axis=0) + np.float32(1e-12)
    curvature = np.linalg.norm(through(v, lambda m, share, _: share * m), axis=0)
    step = (1 / (2 * curvature + strength)).astype(np.float32)
    w, ahead = np.zeros_like(v), np.zeros_like(v)
    for k in range(rounds):
        grad = -2 * through(ahead, lambda m, share, y: share * np.maximum(1 - y * m, 0) * y) + np.float32(strength) * ahead
        new = ahead - step * grad
        ahead = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w


@dataclass
class Model:
    languages: list[str]
    families: list[str]
    weights: np.ndarray  # trigrams and bias by machine: families first, then pairs
    pairs: list[tuple[int, int]]
    family: np.ndarray  # of each language

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row of features."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        n, f = len(x), len(self.families)
        rows = np.arange(n)
        if f > 1:
            chosen = margins[:, :f].argmax(1)
            rest = margins[:, :f].copy()
            rest[rows, chosen] = -np.inf
            score = 1 / (1 + np.exp(-2 * (margins[rows, chosen] - rest.max(1))))
        else:
            chosen, score = np.zeros(n, np.int64), np.ones(n)
        votes = np.zeros((n, len(self.languages)))
        for k, (a, b) in enumerate(self.pairs):
            m = margins[:, f + k]
            # A vote, and the margin as a share of one vote, for ties.
            votes[:, a] += (m >= 0) + 0.4 * np.tanh(m)
            votes[:, b] += (m < 0) - 0.4 * np.tanh(m)
        votes[self.family[None, :] != chosen[:, None]] = -np.inf
        best = votes.argmax(1)
        for k, (a, b) in enumerate(self.pairs):
            m = margins[:, f + k]
            score = np.where(best == a, np.minimum(score, 1 / (1 + np.exp(-2 * m))), score)
            score = np.where(best == b, np.minimum(score, 1 / (1 + np.exp(2 * m))), score)
        return best, score


def train(texts: list[str], langs: list[str]) -> Model | None:
    if not texts:
        return None
    languages = sorted(set(langs))
    families = sorted({family_of(c) for c in languages})
    family = np.array([families.index(family_of(c)) for c in languages])
    code = {c: k for k, c in enumerate(languages)}
    y = np.array([code[c] for c in langs])
    of_family = [np.flatnonzero(family[y] == f) for f in range(len(families))]
    blocks = [blocks_of([texts[k] for k in rows], y[rows]) for rows in of_family]
    # Frequent trigrams vary more; the scale is folded back into the weights below.
    total, squares = np.zeros(DIM), np.zeros(DIM)
    for b in sum(blocks, []):
        total += np.bincount(b.column, b.value, DIM)
        squares += np.bincount(b.column, b.value * b.value, DIM)
    mean = total / len(texts)
    deviation = np.sqrt(np.maximum(squares / len(texts) - mean * mean, 0))
    scale = (1 / (deviation + 1e-4) / np.sqrt(DIM)).astype(np.float32)
    for b in sum(blocks, []):
        b.value *= scale[b.column]
    machines, pairs = [np.zeros((DIM + 1, 1), np.float32)], []
    if len(families) > 1:
        machines = [linear_svms(sum(blocks, []), np.where(family[:, None] == np.arange(len(families)), 1, -1).astype(np.int8))]
    for f in range(len(families)):
        inside = list(combinations(np.flatnonzero(family == f).tolist(), 2))
        if inside:
            signs = np.zeros((len(languages), len(inside)), np.int8)
            for k, (a, b) in enumerate(inside):
                signs[a, k], signs[b, k] = 1, -1
            machines.append(linear_svms(blocks[f], signs))
            pairs += inside
    weights = np.concatenate(machines, 1)
    weights[:-1] *= scale[:, None]
    return Model(languages, families, weights, pairs, family)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32(doc_id as text) leaves the remainder ``part``; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def bounded_sample(rows: DataFrame, by: str, most: int, key: tuple[str, ...], groups: int | None = None) -> DataFrame:
    """Up to ``most`` rows of each value of a column, or of its most frequent ``groups`` values, in
    different keys: those whose key has the smallest hash. The number of different keys of a value sets a
    bound on the hash that leaves some times as many rows as are needed, or all, so that ranking them
    takes no large group to one task."""
    span = 1 << 30
    h = F.xxhash64(*key)
    top = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("count"), F.approx_count_distinct(h, 0.02).alias("keys"))
    if groups is not None:
        top = top.orderBy(F.desc("count"), by).limit(groups)
    bound = F.least(F.lit(span), F.floor(F.lit(float(span * 4 * most)) / F.col("keys")) + 1)
    near = rows.join(F.broadcast(top.select(by, bound.alias("sample_bound"))), by).withColumn("sample_key", h)
    near = near.where(F.pmod("sample_key", F.lit(span)) < F.col("sample_bound")).dropDuplicates([by, "sample_key"])
    nth = F.row_number().over(W.partitionBy(by).orderBy(F.pmod("sample_key", F.lit(span)), "sample_key"))
    return near.withColumn("sample_nth", nth).where(F.col("sample_nth") <= most).drop("sample_bound", "sample_key")


def within_bytes(sample: DataFrame, by: str, most_bytes: int) -> DataFrame:
    """Rows of a bounded sample in their order as long as the texts of a value sum up to most_bytes; a longer
    text comes after all others, and each value keeps one row at least."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    order = W.partitionBy(by).orderBy(size > most_bytes, "sample_nth")
    upto = F.sum(size.cast("long")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    kept = sample.withColumn("sample_upto", upto).withColumn("sample_rank", F.row_number().over(order))
    return kept.where((F.col("sample_upto") <= most_bytes) | (F.col("sample_rank") == 1))


def has_letter(text: str = "text") -> Column:
    """Whether a text has a letter; a null one has none."""
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def training_rows(documents: DataFrame, per_language: int = PER_LANGUAGE, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """The bounded sample: (text, lang) of up to per_language documents of each language."""
    rows = documents.where(~held_out(F.col("doc_id"), 4, 2)).where("lang is not null").where(has_letter()).select("doc_id", "lang", "text")
    picked = within_bytes(bounded_sample(rows, "lang", per_language, ("doc_id", "text")), "lang", most_bytes)
    found = sorted((r["lang"], r["text"]) for r in picked.select("lang", "text").collect())
    return [(t, c) for c, t in found]


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    rows = training_rows(documents, per_language)
    return train([t for t, _ in rows], [c for _, c in rows])


def identify(documents: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, lang_pred and score of each document."""
    bounded_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    shape = documents.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            text = batch.column("identify_text")
            langs, scores = [], []
            if m is not None:
                names = np.array(m.languages, object)
                for piece in pieces(text):
                    best, score = m.predict(features(piece))
                    langs += names[best].tolist()
                    scores += np.round(score, 6).tolist()  # the same for equal texts in any piece
            else:
                langs, scores = [UNKNOWN] * len(text), [0.0] * len(text)
            letters = batch.column("identify_letters").to_pylist()
            langs = [c if ok else UNKNOWN for c, ok in zip(langs, letters, strict=True)]
            scores = [s if ok else 0.0 for s, ok in zip(scores, letters, strict=True)]
            cols = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    letters = has_letter().alias("identify_letters")
    return documents.select(*keep, F.col("text").alias("identify_text"), letters).mapInArrow(label, shape)


def language_id(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each document, by a model learnt from those not held out."""
    marked = documents.select("doc_id", "text", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    return identify(marked, fit(documents, per_language), ("doc_id", "held_out"))
