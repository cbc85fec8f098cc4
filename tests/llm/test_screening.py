import numpy as np
from hypothesis import given, settings, strategies as st

from barline.llm import decontaminate, langid, licenses, quality

from . import brute

ITEMS = [(1, "The quick brown fox jumps over the lazy dog while it rains"), (2, "tiny item"), (3, None), (4, "..."), (None, "nameless benchmark item"), (5, "tiny item")]


def leak_docs():
    long = ITEMS[0][1]
    return [
        (1, "before " + long.upper() + " after"), (2, long[:40]), (3, "a TINY, item!"), (4, None), (5, ""), (6, "the nameless benchmark item is here"),
        (7, " ".join(["tiny item"] * 50)), (8, "quick brown fox jumps over the lazy dog while it rains"), (9, "été tiny-item"), (10, "x " * 20_000 + long),
    ]


def plain(docs):
    named = [x for x in ITEMS if x[0] is not None]
    both, known = brute.leaks(docs, [(i if i is not None else "?", t) for i, t in ITEMS]), brute.leaks(docs, named)
    return {i: (*both[i][:2], *known[i][2:4], both[i][4]) for i in both}


def test_decontamination_is_what_a_plain_search_finds(spark):
    docs = leak_docs()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (1 << 20, 60):
        df = decontaminate.decontaminate(brute.frame(spark, docs), bench, block_bytes=block)
        assert {r[0]: tuple(r)[1:] for r in df.collect()} == plain(docs)


def test_decontaminated_texts_lose_the_spans_only(spark):
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    docs = [(1, f"Keep this. {ITEMS[0][1]}! And é this."), (2, "nothing here"), (3, None)]
    for block in (1 << 20, 10):
        df = decontaminate.decontaminate(brute.frame(spark, docs), bench, block_bytes=block, with_text=True)
        assert {r.doc_id: r.kept_text for r in df.collect()} == {1: "Keep this. ! And é this.", 2: "nothing here", 3: ""}


def test_decontamination_without_a_benchmark(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.decontaminate(brute.frame(spark, [(1, "a b"), (2, None)]), bench).collect()
    assert sorted((r.doc_id, r.n_words, r.contaminated) for r in rows) == [(1, 2, False), (2, 0, False)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=5))
def test_fm_index_locates_every_occurrence(runs, patterns):
    text = [x for run in runs for x in [*run, 0]]
    index = decontaminate.FMIndex(np.array(text), 5)
    size = np.array([len(p) for p in patterns])
    low, high = index.search(np.concatenate(patterns), np.cumsum(size) - size, size)
    for p, a, b in zip(patterns, low, high):
        want = [k for k in range(len(text) - len(p) + 1) if text[k : k + len(p)] == p]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_license_scan(spark):
    mit = " ".join(licenses.TEMPLATES["MIT"][2].split())
    docs = [
        (1, "Some text.\nReleased under the MIT License.\nmore"), (2, mit), (3, "First half of it\n" + mit[: len(mit) // 4]), (4, None), (5, ""), (6, "licensed under the apache LICENSE version 2 0"),
        (7, "word " * 50_000 + "\nLicensed under CC BY-NC 4.0."), (8, "A license to read"), (9, "Released under the MIT License.\nReleased under the MIT License."),
    ]
    got = {r.doc_id: r for r in licenses.license_scan(brute.frame(spark, docs)).collect()}
    assert {i: r.license for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "Apache-2.0", 7: "CC-BY-NC-4.0", 8: None, 9: "MIT"}
    assert (got[1].unit, got[1].line, got[1].dice) == ("line", 1, 1.0) and got[9].n_matches == 2 and got[4].dice == 0.0
    assert licenses.license_scan(brute.frame(spark, docs).where("doc_id < 0")).count() == 0


def test_license_scan_is_what_comparing_all_gives(spark):
    import random

    rnd, docs = random.Random(3), []
    pool = [n for t in licenses.TEMPLATES.values() for n in t]
    for i in range(60):
        words = rnd.choice(pool).split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"z{rnd.randint(0, 3)}"
        docs.append((i, " ".join(words[: rnd.randint(3, len(words))])))

    def grams(t):
        w = brute.ALNUM_WORD.findall(brute.lower(t))
        return {tuple(w[k : k + 2]) for k in range(max(len(w) - 1, 1))} if w else set()

    for r in licenses.license_scan(brute.frame(spark, docs)).collect():
        a = grams(docs[r.doc_id][1])
        best = max(((2 * len(a & grams(n)) / (len(a) + len(grams(n))), name) for name, t in licenses.TEMPLATES.items() for n in t), key=lambda x: x[0])[0]
        assert r.dice == (best if best >= licenses.LEAST else 0.0)


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() >= 0.98
    assert got.score.between(0, 1).all()


def test_language_id_of_odd_rows(spark):
    docs = brute.frame(spark, [(k, "the cat sat on the mat with the dog" if k % 2 else "le chat est sur le tapis avec le chien") for k in range(40)])
    model = langid.fit(docs)
    odd = brute.frame(spark, [(1, None), (2, ""), (3, "123 !!"), (4, "le chien " * 50_000), (None, "the dog"), (4, "x")])
    got = sorted((r.doc_id or 0, r.lang_pred, r.score >= 0) for r in langid.identify(odd, model).collect())
    assert [x[1] for x in got[:4]] == ["en", "und", "und", "und"] and ("fr" in [x[1] for x in got[4:]])
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(odd.where("doc_id > 99"), model).count() == 0
    assert langid.language_id(odd.where("doc_id > 99")).count() == 0


def test_hierarchy_has_a_machine_for_each_pair_of_a_family():
    texts = [f"{w} {w}ing the" for w in ("cat", "dog")] * 5 + ["der die das und"] * 10 + ["le la les et"] * 10 + ["slovo dobro ne"] * 10
    model = langid.train(texts, ["en"] * 10 + ["de"] * 10 + ["fr"] * 10 + ["pl"] * 10)
    assert model.families == ["germanic", "romance", "slavic"] and model.pairs == [(0, 1)]


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    balanced = (got.predicted == got.quality).groupby(got.quality).mean().mean()
    assert balanced >= 0.9 and got.score.between(0, 1).all()


def test_quality_of_odd_rows(spark):
    net = quality.train(["GOOD text here. " * 10, "BAD!! BAD!! BAD!! " * 10] * 8, [1, 0] * 8, epochs=4)
    odd = brute.frame(spark, [(1, None), (2, ""), (3, "a"), (4, "BAD!! " * 60_000), (None, "x"), (3, "a")])
    got = quality.score_documents(odd, net).toPandas()
    assert len(got) == 6 and got.score.between(0, 1).all()
    assert got[got.doc_id == 3].score.nunique() == 1
    assert set(quality.score_documents(odd, None).toPandas().score) == {0.5}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert set(quality.quality_scores(odd, labels).toPandas().predicted) == {1}
    assert quality.score_documents(odd.where("doc_id > 99"), net).count() == 0


def test_scores_do_not_depend_on_neighbours():
    net = quality.Network.fresh()
    texts = [b"abc", b"x" * 130, b"", b"hello world " * 40]
    alone = [net.score(*quality.blocks(np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0] for t in texts]
    data = np.frombuffer(b"".join(texts), np.uint8)
    together = net.score(*quality.blocks(data, np.cumsum([0, *map(len, texts)])))
    assert np.allclose(alone, together, atol=1e-6)


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = quality.Network.fresh()
    data = rng.integers(0, 256, 700).astype(np.uint8)
    rows, first = quality.blocks(data, np.array([0, 300, 700]))
    y, w = np.array([1.0, 0.0], np.float32), np.array([1.0, 1.0], np.float32)
    grads = quality._step(net, rows, first, y, w)

    def loss():
        p = net.score(rows, first)
        return -np.log(np.where(y > 0, p, 1 - p)).sum()

    for param, grad in zip([net.filters, net.out], grads[1::2]):
        k = int(np.abs(grad).argmax())
        flat = param.reshape(-1)
        old = flat[k]
        flat[k] = old + 1e-2
        up = loss()
        flat[k] = old - 1e-2
        down = loss()
        flat[k] = old
        assert abs((up - down) / 2e-2 - grad.reshape(-1)[k]) < 0.05 * abs(grad.reshape(-1)[k]) + 1e-3
