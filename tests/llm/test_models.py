"""Scores against plain versions, and the bounded samples that the models learn from."""

import math
import random

import numpy as np

from barline.llm import langid, quality

from . import brute

TEXTS = ["", "a", "ab", "Der Hund läuft!", "the  cat sat.\n", "x" * 300, "le chat " * 60, "été", "123 the dog", "ß"]


def plain_trigrams(text: str) -> dict[int, float]:
    code = [b - 0x80 + 27 if b >= 0x80 else ord(chr(b).lower()) - 96 if chr(b).isalpha() else 0 for b in text.encode()] + [0, 0]
    found = [((((a * 160 + b) * 160 + c) * 0x9E3779B1) >> 15) % langid.DIM for a, b, c in zip(code, code[1:], code[2:])]
    return {t: found.count(t) / len(found) for t in set(found)}


def plain_language(model: langid.Model, text: str) -> tuple[str, float]:
    share = plain_trigrams(text)
    margin = [sum(s * float(w[t]) for t, s in share.items()) + float(w[-1]) for w in model.weights.T]
    f = len(model.families)
    ranked = sorted(range(f), key=lambda k: -margin[k])
    family = ranked[0]
    score = 1 / (1 + math.exp(-2 * (margin[ranked[0]] - margin[ranked[1]])))
    votes = {k: 0.0 for k in range(len(model.languages)) if model.family[k] == family}
    for (a, b), m in zip(model.pairs, margin[f:]):
        for k, won, m in ((a, m >= 0, m), (b, m < 0, -m)):
            if k in votes:
                votes[k] += won + 0.4 * math.tanh(m)
    best = max(votes, key=votes.get)
    for (a, b), m in zip(model.pairs, margin[f:]):
        if best in (a, b):
            score = min(score, 1 / (1 + math.exp(-2 * (m if best == a else -m))))
    return model.languages[best], score


def test_languages_are_what_a_plain_vote_gives(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").limit(400).collect()
    rows = [(r.text, r.lang) for r in docs if r.text and r.lang]
    # Two more languages, so that a family has several pairs.
    rows += [(t.replace("a", "o"), "nl" if c == "de" else "it") for t, c in rows if c in ("de", "fr")]
    model = langid.train([t for t, _ in rows], [c for _, c in rows])
    assert len(model.pairs) >= 2
    texts = [t for t in TEXTS if any(c.isalpha() for c in t)] + [t for t, _ in rows[::9]]
    got = langid.identify(brute.frame(spark, list(enumerate(texts))), model).collect()
    assert len(got) == len(texts)
    for r in got:
        lang, score = plain_language(model, texts[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa

    together = np.concatenate([langid.features(p) for p in langid.pieces(pa.array(TEXTS, pa.large_string()))])
    for k, t in enumerate(TEXTS):
        want = np.zeros(langid.DIM)
        for at, share in plain_trigrams(t).items() if t else ():
            want[at] = share
        assert np.allclose(together[k], want, atol=1e-6)


def plain_score(net: quality.Network, text: str) -> float:
    """One window after another: each block's highest responses, chunks of two blocks, mean and highest."""
    data, n = text.encode(), quality.FILTERS
    blocks = []
    for at in range(0, max(len(data), 1), quality.BLOCK):
        best = [0.0] * n
        for p in range(at, at + quality.BLOCK, quality.STRIDE):
            seen = np.concatenate([net.embed[data[q] if q < len(data) else 0] for q in range(p, p + quality.WIDTH)])
            best = [max(b, float(seen @ net.filters[:, f] + net.bias[f])) for f, b in enumerate(best)]
        blocks.append(best)
    chunks = [[max(x) for x in zip(*blocks[k : k + 2])] for k in range(len(blocks))]
    mean = [sum(c[f] for c in chunks) / len(chunks) for f in range(n)]
    high = [max(c[f] for c in chunks) for f in range(n)]
    z = sum(m * float(w) for m, w in zip(mean + high, net.out)) + float(net.out[-1])
    return 1 / (1 + math.exp(-z))


def test_quality_is_what_plain_loops_give(spark):
    net = quality.train(["GOOD text here. " * 10, "BAD!! BAD!! BAD!! " * 10] * 8, [1, 0] * 8, epochs=3)
    texts = [*TEXTS, "BAD!! GOOD " * 40]
    for r in quality.score_documents(brute.frame(spark, list(enumerate(texts))), net).collect():
        assert abs(r.score - plain_score(net, texts[r.doc_id])) < 1e-4


def test_a_repeated_doc_id_does_not_empty_the_sample(spark):
    docs = [(4, f"le chat {k}", "fr") for k in range(3000)] + [(8, "the dog", "en")] * 3000
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    for shift in range(6):
        moved = df.select((langid.F.col("doc_id") + 100 * shift).alias("doc_id"), "text", "lang")
        if moved.where(~langid.held_out(langid.F.col("doc_id"), 4, 2)).select("doc_id").distinct().count() < 2:
            continue
        found = langid.training_rows(moved, 20)
        assert [c for _, c in found] == ["en"] + ["fr"] * 20 and len({t for t, _ in found}) == 21


def test_samples_are_bounded_in_bytes(spark):
    rnd = random.Random(1)
    docs = [(k, "word " * rnd.randint(1, 60), "en" if k % 2 else "fr") for k in range(600)] + [(9001 + k, "lang " * 5000, "de") for k in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    found = langid.training_rows(df, 200, 2000)
    size = {c: sum(len(t) for t, x in found if x == c) for c in ("en", "fr", "de")}
    assert 1500 < size["en"] <= 2000 and 1500 < size["fr"] <= 2000
    # A language whose texts are all longer keeps one.
    assert [c for _, c in found].count("de") == 1


def test_one_row_for_each_label(spark):
    docs = brute.frame(spark, [(1, f"text {k % 7}") for k in range(500)] + [(k, f"other {k}") for k in range(2, 40)] + [(90, None)])
    labels = spark.createDataFrame([(k, k % 2, 0, "clash") for k in range(200)] + [(1, 1, 0, "again"), (None, 1, 0, "x"), (3, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    found = quality.training_rows(docs, labels)
    want = [k for k in (*range(1, 40), 90) if not spark.sql(f"SELECT crc32('{k}') % 3 = 1").first()[0]]
    assert len(found) == len(want) and [t for t, _ in found].count("text 0") == (1 in want)
    assert len(quality.training_rows(docs, labels, 5)) == 10
