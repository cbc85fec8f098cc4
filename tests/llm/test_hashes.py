"""Strings whose differences cancel out in sums of powers modulo 2**64: they must be told apart."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from barline.llm import decontaminate, fingerprints, licenses, ngram_join, substring_dedup, textkit as tk

from . import brute


def swapped(length: int, letters: str = "ab") -> tuple[str, str]:
    """A Thue-Morse string, and the one with its two letters swapped."""
    bits = [0]
    while len(bits) < length:
        bits += [1 - b for b in bits]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


SIZES = (1024, 2048, 4096)


def one(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def test_names_of_strings_and_sequences_differ():
    for n in (64, 512, *SIZES, 1 << 16):
        a, b = (tk.span_hash(one(t), np.array([0]), np.array([n]))[0] for t in swapped(n))
        assert a != b
        names = tk.mix(np.array([1, 2], np.uint64))
        a, b = (tk.seq_hash(names[one(t) - ord("a")], np.array([0]), n)[0] for t in swapped(n))
        assert a != b


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.data())
def test_a_name_depends_on_the_bytes_alone(body, data):
    """The same string has one name, wherever it stands and whatever else is named with it."""
    start = data.draw(st.integers(0, len(body) - 1))
    end = data.draw(st.integers(start, len(body)))
    alone = tk.span_hash(np.frombuffer(body[start:end], np.uint8), np.array([0]), np.array([end - start]))[0]
    starts = np.arange(len(body))
    many = tk.span_hash(np.frombuffer(body, np.uint8), np.append(starts, start), np.append(np.minimum(starts + end - start, len(body)), end))
    assert many[-1] == alone
    same = [s for s in range(len(body)) if body[s : min(s + end - start, len(body))] == body[start:end]]
    assert (many[same] == alone).all() and (many == alone).sum() == len(same) + 1


@pytest.mark.parametrize("size", SIZES)
def test_words(spark, size):
    a, b = swapped(size)
    rest = [f"w{k}" for k in range(30)]
    docs = [(1, " ".join([a, *rest])), (2, " ".join([b, *rest])), (3, " ".join([*rest[:25], a, *rest[25:]])), (4, a), (5, b), (6, a + "\n" + b)]
    frame = brute.frame(spark, docs)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(frame).collect()}
    assert got == brute.substring(docs) and got[2][1] == 30
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame).collect()}
    assert got == brute.jaccard(docs) and got[5][1] == 5
    items = [(1, " ".join([a, *rest[:9]])), (2, b), (3, " ".join(rest[3:13]))]
    found = decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()}
    assert got == brute.leaks(docs, items) and got[2][1] == 11


@pytest.mark.parametrize("size", SIZES)
def test_paragraphs_and_notices(spark, size):
    a, b = swapped(size)
    docs = [(1, a + "\nsame"), (2, b + "\nsame"), (3, a + "\nsame"), (4, "x " + a + " y"), (5, "x " + b + " y")]
    texts = dict(docs)
    found = {r.doc_id: r for r in fingerprints.fingerprint_versions(brute.frame(spark, docs)).collect()}
    for i, j in zip((1, 2, 3, 4, 5), (2, 3, 4, 5, 1)):
        assert abs(found[i].near_next - brute.likeness(texts[i], texts[j])) < 1e-12
    assert found[1].fingerprint == found[3].fingerprint != found[2].fingerprint
    found = {r.doc_id: r.license for r in licenses.license_scan(brute.frame(spark, docs), texts={"L": (f"x {a} y",)}).collect()}
    assert found == {1: None, 2: None, 3: None, 4: "L", 5: None}
