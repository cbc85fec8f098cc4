import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from barline.llm import ngram_join, repeats, substring_dedup, suffix_dedup, textkit as tk

from . import brute


def rows(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


def test_cover_holds_every_difference():
    for p in (2, 3, 5, 7, 11, 13):
        v, d = suffix_dedup.difference_set(p)
        assert (v, len(d)) == (p * p + p + 1, p + 1) and (np.diff(d) > 0).all() and d.max() < v
        assert len({(a - b) % v for a in d.tolist() for b in d.tolist()}) == v
    assert [suffix_dedup.cover_for(n)[0] for n in (3, 5, 256, 400)] == [3, 3, 133, 183]


@given(st.lists(st.integers(0, 10**6), min_size=1).map(sorted))
def test_gaps_round_trip(numbers):
    assert repeats.unpack_gaps(repeats.pack_gaps(np.array(numbers))).tolist() == numbers


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=20, max_size=20) | st.text("abcd", min_size=20, max_size=20), st.lists(st.text("abcd", max_size=12), min_size=4, max_size=4))
def test_equal_windows_share_an_anchor(window, around):
    """Whatever stands around a window of 20 words, an anchor at offset 9 or less is common to all places."""
    found = []
    for left, right in (around[:2], around[2:]):
        words = np.array([ord(c) for c in left + window + right], np.uint64)
        at = substring_dedup.anchors(tk.mix(words), np.array([0, len(words)])) - len(left)
        found.append({int(x) for x in at if 0 <= x <= substring_dedup.REACH})
    assert found[0] & found[1]


def test_substring_dedup_is_what_a_plain_search_finds(spark):
    docs = brute.corpus()
    got = rows(substring_dedup.substring_dedup(brute.frame(spark, docs)), "n_words", "n_removed", "kept_sha256")
    want = brute.substring(docs)
    assert got == want and sum(w[1] for w in want.values()) > 1000


def test_substring_dedup_of_repeated_rows_and_nulls(spark):
    text = " ".join(str(k) for k in range(30))
    docs = [(1, text), (1, text), (None, text), (2, None), (3, text)]
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(brute.frame(spark, docs)).collect())
    # The row without a doc_id orders first and keeps its words; rows of document 1 come later alike.
    assert got == [(0, 30, 0), (1, 30, 30), (1, 30, 30), (2, 0, 0), (3, 30, 30)]
    same = sorted(r.n_removed for r in substring_dedup.substring_dedup(brute.frame(spark, docs[:2])).collect())
    assert same == [0, 0]


def test_texts_of_one_doc_id_that_tie_for_the_first_place(spark):
    """Rows of document 5 with different texts share a start, which also stands in document 1."""
    start = " ".join(f"w{k}" for k in range(25))
    docs = [(5, start + " one"), (5, start + " two"), (5, start + " two"), (1, "before " + start), (7, start)]
    for parts in (1, 4):
        got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(brute.frame(spark, docs, parts)).collect())
        assert got == [(1, 26, 0), (5, 26, 25), (5, 26, 25), (5, 26, 25), (7, 25, 25)]


def edited_copies(seed: int = 2):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdefghij ") for _ in range(1500)) for _ in range(3)]
    docs = brute.corpus(n=30)
    for i in range(40):
        t = rnd.choice(base)
        for _ in range(rnd.randint(0, 3)):
            j = rnd.randrange(len(t))
            t = t[:j] + rnd.choice(["X", "", "YY", "é"]) + t[j + 1 :]
        if i % 3 == 0:
            k = rnd.randint(0, 900)
            t = t[k : k + rnd.randint(100, 600)]
        docs.append((100 + i, t * 2 if i % 7 == 0 else t))
    return docs


@pytest.mark.parametrize(("length", "passage"), [(400, 256), (256, 256), (120, 30), (9, 400)])
def test_suffix_dedup_is_what_a_plain_search_finds(spark, length, passage):
    docs = edited_copies(length)
    got = rows(suffix_dedup.remove_repeats(brute.frame(spark, docs), length, passage), "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared")
    assert {i: x[:4] for i, x in got.items()} == brute.suffix(docs, length)
    assert {i: x[4] for i, x in got.items()} == brute.shared_tuples(docs, min(length, passage))
    short = brute.suffix(docs, min(length, passage))
    assert all(got[i][4] > 0 for i in got if short[i][1])


def test_passages_at_the_limit(spark):
    """Strings of 399, 400 and 401 bytes, with characters of two and three bytes at their ends."""
    rnd, docs = random.Random(8), []
    for k, n in enumerate((399, 400, 401)):
        for j, (head, tail) in enumerate((("", ""), ("é", "é"), ("€", "é"), ("", "€"))):
            inside = n - len((head + tail).encode())
            passage = head + "".join(rnd.choice("abcdefgh") for _ in range(inside)) + tail
            for copy in range(2):
                around = ["".join(rnd.choice("uvwxyz ") for _ in range(rnd.randint(0, 200))) for _ in range(2)]
                docs.append((100 * k + 10 * j + copy, f"{copy}{around[0]}{copy}{passage}{copy}{around[1]}"))
    got = rows(suffix_dedup.remove_repeats(brute.frame(spark, docs)), "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared")
    assert {i: x[:4] for i, x in got.items()} == brute.suffix(docs)
    assert [{x[1] for i, x in got.items() if i // 100 == k} for k in range(3)] == [{0}, {400}, {401}]
    assert all(x[4] >= 124 for x in got.values())


def test_suffix_dedup_counts_repeated_rows_and_gives_texts(spark):
    text = "é" * 300
    df = suffix_dedup.remove_repeats(brute.frame(spark, [(1, text), (1, text), (2, "short"), (None, None)]), with_text=True)
    got = sorted((r.doc_id or 0, r.n_removed, r.kept_text, r.row.lang is not None) for r in df.collect())
    assert got == [(0, 0, "", True), (1, 600, "", True), (1, 600, "", True), (2, 0, "short", True)]


def test_jaccard_join_is_what_all_pairs_give(spark):
    docs = brute.corpus(n=90)
    got = rows(ngram_join.jaccard_components(brute.frame(spark, docs)), "n_shingles", "component_id")
    want = brute.jaccard(docs)
    assert got == want and sum(i != w[1] for i, w in want.items()) > 5


def test_jaccard_join_of_chains_and_the_threshold(spark):
    words = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join(words[2 * k : 2 * k + 30])) for k in range(12)]
    docs += [(50, "a b c d"), (51, "A  b C d"), (52, "a b c e")]
    docs += [(60, " ".join(f"x{k}" for k in range(13))), (61, " ".join(f"x{k}" for k in range(14))), (62, " ".join(f"x{k}" for k in range(16)))]
    got = rows(ngram_join.jaccard_components(brute.frame(spark, docs)), "n_shingles", "component_id")
    assert got == brute.jaccard(docs)


def test_one_of_each_leaves_columns_with_names_like_its_own(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = brute.frame(spark, [(1, text), (2, text), (3, "other")]).withColumnRenamed("at", "jaccard_rid").withColumnRenamed("rid", "label")
    got = ngram_join.one_of_each(df)
    assert got.columns == df.columns and sorted((r.doc_id, r.jaccard_rid, r.label) for r in got.collect()) == [(1, "a", "x"), (3, "a", "x")]


def test_one_of_each_keeps_the_first_and_all_empty_documents(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = [(5, text), (3, text), (3, text), (9, text + " more"), (1, None), (2, ""), (4, "other words here"), (None, " ")]
    kept = sorted((r.doc_id or 0) for r in ngram_join.one_of_each(brute.frame(spark, docs)).collect())
    assert kept == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed", range(4))
def test_region_links_connect_what_is_connected(seed):
    rnd = random.Random(seed)
    sets = []
    for _ in range(40):
        if sets and rnd.random() < 0.7:
            s = set(rnd.choice(sets))
            s = s - set(rnd.sample(sorted(s), min(len(s) - 1, rnd.randint(0, 3)))) | {rnd.randrange(10**6) for _ in range(rnd.randint(0, 3))}
        else:
            s = {rnd.randrange(10**6) for _ in range(rnd.randint(1, 30))}
        sets.append(s)
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                top[find(a)] = find(b)
    want = [find(k) for k in range(len(sets))]
    top = list(range(len(sets)))
    for a, b in ngram_join.region_links([np.array(sorted(s), np.uint64) for s in sets]):
        both = len(sets[a] & sets[b])
        assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
        top[find(a)] = find(b)
    got = [find(k) for k in range(len(sets))]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_empty_tables(spark):
    none = brute.frame(spark, [(1, "x")]).where("doc_id < 0")
    for f in (substring_dedup.substring_dedup, suffix_dedup.remove_repeats, ngram_join.jaccard_components, ngram_join.one_of_each):
        assert f(none).count() == 0
