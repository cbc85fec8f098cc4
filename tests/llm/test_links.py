"""Numbers of links of the n-gram join against all pairs."""

import random

import numpy as np

from barline.llm import ngram_join

from . import brute


def linked(docs):
    sets = [brute.shingles(t) for _, t in docs]
    return [sum(1 for j, y in enumerate(sets) if j != i and x and y and 100 * len(x & y) >= 80 * len(x | y)) for i, x in enumerate(sets)]


def near_copies(n: int):
    rnd, words = random.Random(2), [f"w{k}" for k in range(150)]
    docs = []
    for i in range(n):
        mine = list(words)
        for _ in range(rnd.randint(0, 4)):
            mine[rnd.randrange(len(mine))] = f"n{rnd.randint(0, 9)}"
        docs.append((1000 + i, " ".join(mine[: rnd.randint(135, 150)])))
    return docs


def test_no_link_is_lost(spark):
    docs = brute.corpus(n=60) + near_copies(40) + [(2000, "a b c d e f"), (2001, "a b c d e f")]
    want = {i: n for (i, _), n in zip(docs, linked(docs))}
    got = {r.doc_id: r.n_links for r in ngram_join.jaccard_components(brute.frame(spark, docs)).collect()}
    assert got == want and 10 < sum(n for i, n in want.items() if i >= 1000) < 40 * 39


def test_regions_that_are_split_lose_no_link(spark, monkeypatch):
    docs = brute.corpus(n=40) + near_copies(60)
    want = {i: (n, c[1]) for (i, _), n, c in zip(docs, linked(docs), brute.jaccard(docs).values())}
    for size in (2000, 300):
        monkeypatch.setattr(ngram_join, "REGION_SHINGLES", size)
        got = {r.doc_id: (r.n_links, r.component_id) for r in ngram_join.jaccard_components(brute.frame(spark, docs)).collect()}
        assert got == want


def test_members_are_sent_in_bounded_batches(spark, monkeypatch):
    docs = brute.corpus(n=40) + near_copies(40)
    want = {i: (n, c[1]) for (i, _), n, c in zip(docs, linked(docs), brute.jaccard(docs).values())}
    monkeypatch.setattr(ngram_join, "SENT_BYTES", 1000)
    for region in (ngram_join.REGION_SHINGLES, 2000):
        monkeypatch.setattr(ngram_join, "REGION_SHINGLES", region)
        got = {r.doc_id: (r.n_links, r.component_id) for r in ngram_join.jaccard_components(brute.frame(spark, docs)).collect()}
        assert got == want


def test_blocks_of_overlaps(monkeypatch):
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(0, 50))).astype(np.uint64) for _ in range(70)]
    for block, columns, expand in ((256, 4096, 4_000_000), (7, 5, 11)):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "COLUMNS", columns)
        monkeypatch.setattr(ngram_join, "EXPAND", expand)
        for heavy in (sets, [s + np.uint64(1000 * (k % 30)) for k, s in enumerate(sets)]):
            got = ngram_join.Overlaps(heavy).block(3, 40, 5, 70)
            want = np.array([[len(np.intersect1d(a, b)) for b in heavy[5:70]] for a in heavy[3:40]])
            assert ((got == want) | np.eye(37, 65, -2, bool)).all()


def test_a_large_group_of_near_copies_is_one_component(spark):
    """Twelve thousand different sets that share most of their shingles, and others that share none with them."""
    from pyspark.sql import functions as F

    words = F.concat_ws(" ", *[F.when(F.pmod(F.xxhash64("doc_id"), F.lit(60)) == k, F.concat(F.lit("changed"), F.col("doc_id").cast("string"))).otherwise(F.lit(f"word{k}")) for k in range(60)])
    alone = F.concat_ws(" ", *[F.concat(F.lit(f"x{k}y"), F.col("doc_id").cast("string")) for k in range(30)])
    docs = spark.range(14_000).select(F.col("id").alias("doc_id")).select("doc_id", F.when(F.col("doc_id") < 12_000, words).otherwise(alone).alias("text"))
    found = ngram_join.jaccard_components(docs, counted=False)
    got = {(r.component_id, r.n): 1 for r in found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").collect()}
    assert got == {(0, 12_000): 1} and found.count() == 14_000
    assert ngram_join.one_of_each(docs).count() == 2001
