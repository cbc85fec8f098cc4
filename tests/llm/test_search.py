"""Divergence, ranked search and neighbours against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from barline.llm import divergence, neighbours, ranked_search, textkit as tk

from . import brute

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, term string, n long, docs long, base long, code int, q int"


def documents(spark, rows, parts=3):
    """Rows (doc_id, text, lang, source), with extra columns whose names operators use inside."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], DOCS).repartition(parts)


def audited(rows, keep, top=50):
    rows = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    counts, docs, out = defaultdict(Counter), defaultdict(Counter), []
    for t, lang, source in rows:
        words = LETTERS.findall(brute.lower(t))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= keep]
        sources = {s for _, x, s in rows if x == lang}

        def share(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


def invented(n=160, seed=3):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeéñ" for b in ("x", "Y", "zz", "ß", "q1w")]
    rows = []
    for i in range(n):
        bias = rnd.sample(words, 12)
        t = " ".join(rnd.choice(bias) for _ in range(rnd.randint(0, 60)))
        rows.append((i, t, rnd.choice(["en", "fr", None]), rnd.choice(["s0", "s0", "s1", "é", "Z", None])))
    return [*rows, (n, None, "en", "only null"), (n + 1, "", "none", "one"), (n + 2, "12 34", "none", "two"), (n + 3, "word " * 30_000, "en", "s1"), rows[5], rows[5]]


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


AUDIT = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("small", [False, True])
def test_divergence_is_what_plain_counting_gives(spark, monkeypatch, small):
    if small:  # several blocks of groups, chunks of terms and ranges of chunks
        for name, value in (("BLOCK", 2), ("CHUNK", 5), ("CHUNK_ROWS", 9), ("SPAN_ROWS", 40), ("COMBINE", 30), ("FEW", 0)):
            monkeypatch.setattr(divergence, name, value)
    rows = invented()
    got = collected(divergence.source_divergence(documents(spark, rows), keep=9), *AUDIT)
    assert got == audited(rows, 9) and sum(r[2] == "term" for r in got) > 20


def test_divergence_without_terms_and_without_rows(spark):
    rows = [(1, "a b", "x", "s"), (2, None, "x", "t"), (3, "c", "y", "u")]
    got = collected(divergence.source_divergence(documents(spark, rows)), *AUDIT)
    assert got == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]
    assert divergence.source_divergence(documents(spark, [])).count() == 0


def test_shares_do_not_round():
    rnd = random.Random(1)
    for _ in range(300):
        total = rnd.randrange(10, 9 * 10**15)
        count = rnd.randrange(0, total - 5)
        assert divergence.shares(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 5) // total


def ranked(rows, items, k=50):
    docs = [(i, Counter(TERM.findall(brute.lower(t or "")))) for i, t, *_ in rows]
    size = [sum(c.values()) for _, c in docs]
    many, words = sum(n > 0 for n in size), sum(size)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        terms = set(TERM.findall(brute.lower(text or "")))
        scores = []
        for (i, c), n in zip(docs, size):
            m = 100 - 50 + 50 * n * many // max(words, 1)
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k]) if x[0] < 0]
    return sorted(out, key=str)


def library(seed=4):
    rnd = random.Random(seed)
    words = [f"{'Wé'[k % 2]}{k}" for k in range(60)]
    rows = [(i, ", ".join(rnd.choice(words[: rnd.randint(1, 60)]) for _ in range(rnd.randint(0, 80))), "en", "s") for i in range(150)]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "w0 " * 30_000, "en", "s"), (203, rows[7][1], "en", "s"), rows[8], rows[8], (None, rows[9][1], "en", "s")]
    items = [(k, " ".join(rnd.sample(words, rnd.randint(1, 30)))) for k in range(12)]
    return rows, [*items, items[0], (50, None), (51, "?!"), (52, "nowhere"), (None, "w3 w5"), (3, "é7 W8"), (53, "W0")]


@pytest.mark.parametrize("k,block,small", [(50, 1 << 20, False), (3, 1 << 20, True), (1, 100, True)])
def test_ranked_search_is_what_scoring_all_gives(spark, monkeypatch, k, block, small):
    if small:  # lists in parts, several tasks of documents, few items and sums at once
        for name, value in (("LIST_BYTES", 3000), ("TASK_BYTES", 2000), ("ITEMS", 4), ("EXPAND", 50)):
            monkeypatch.setattr(ranked_search, name, value)
        monkeypatch.setattr(tk, "PIECE_BYTES", 500)
        monkeypatch.setattr(tk.pieces, "__defaults__", (500,))
    rows, items = library()
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, q int")
    got = ranked_search.ranked_search(documents(spark, rows), frame, k, block)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == ranked(rows, items, k)


def test_thresholds_keep_postings_back(spark):
    """Rare terms decide; of the frequent term's list few postings are sent, and candidates get theirs looked up."""
    rows = [(i, "common " + (f"rare{i % 5} " * 9 if i < 40 else "filler other"), "en", "s") for i in range(400)]
    items = [(1, "common rare1"), (2, "rare2 rare3 common")]
    got = ranked_search.ranked_search(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == ranked(rows, items, 4)


def test_ranked_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search.ranked_search(documents(spark, [(1, "a", "", "")]), none).count() == 0
    assert ranked_search.ranked_search(documents(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows], "vec_id long, embedding array<float>, region int, q long, score double").repartition(parts)


def exact(rows, every, n=10):
    out = {}
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], np.float32).astype(float)
    for k, i in enumerate(ids):
        if i % every == 0:
            d = np.sqrt(((x - x[k]) ** 2).sum(1))
            by = [j for j in np.lexsort((ids, d)) if j != k][:n]
            out[i] = [(ids[j], d[j]) for j in by]
    return out


def lists(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return dict(out)


def test_neighbours_recall_and_exact_distances(spark):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(20, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 20] + 0.3 * rnd.normal(size=16)]) for i in range(3000)]
    want, got = exact(rows, 20), lists(neighbours.nearest_neighbours(vectors(spark, rows), every=20))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 10 * len(want)
    far = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        assert len(near) == 10 and all(abs(s - math.sqrt(((far[q] - far[i]) ** 2).sum())) < 1e-9 for i, s in near)
        assert near == sorted(near, key=lambda x: (x[1], x[0]))


def test_neighbours_in_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ENTRIES", 50)
    rnd = np.random.default_rng(6)
    rows = [(i, [1.0, 2.0, -3.0] if i % 3 else [float(np.float32(x)) for x in rnd.normal(size=3)]) for i in range(900)]
    got = lists(neighbours.nearest_neighbours(vectors(spark, rows), every=10, target=1.0))
    want = exact(rows, 10)
    assert set(got) == set(want)
    for q in want:
        if q % 3:  # ten copies with the smallest ids, but for the query itself
            assert got[q] == want[q] and all(s == 0 for _, s in got[q])
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [0.0, 1.0]), (-100, [-0.0, 1.0]), (200, [0.0, 0.0])]
    got = lists(neighbours.nearest_neighbours(vectors(spark, rows)))
    r = math.sqrt(2)
    assert got == {-100: [(1, 0.0), (0, r), (100, r)], 0: [(100, 0.0), (-100, r), (1, r)], 100: [(0, 0.0), (-100, r), (1, r)]}
    assert neighbours.nearest_neighbours(vectors(spark, rows[2:10])).count() == 0
    assert neighbours.nearest_neighbours(vectors(spark, [])).count() == 0
    assert lists(neighbours.nearest_neighbours(vectors(spark, [(0, [5.0])]))) == {}
    huge = [(0, [3e38, 0.0]), (1, [0.0, 3e38]), (2, [1e-40, 0.0])]
    assert [i for i, _ in lists(neighbours.nearest_neighbours(vectors(spark, huge)))[0]] == [2, 1]


def test_a_walk_passes_pairs_in_order_of_summed_distance():
    rnd = np.random.default_rng(7)
    a, b = rnd.random(9), rnd.random(7)
    count = rnd.integers(0, 4, (9, 7))
    for needed in (1, 20, 10**9):
        got = neighbours.walk(a, b, count.tolist(), needed)
        order = [(i, j) for _, i, j in sorted((a[i] + b[j], i, j) for i in range(9) for j in range(7)) if count[i, j]]
        held = np.cumsum([count[c] for c in order])
        assert got == order[: int(np.searchsorted(held, needed)) + 1]
