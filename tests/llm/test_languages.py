"""Language ID with more languages than the tables have."""

import random

import corpus_pipeline
from barline.llm import langid


def many(n_langs: int, n_docs: int):
    docs = []
    for k in range(n_langs):
        rnd = random.Random(k)
        words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
        docs += [(k * n_docs + d, " ".join(rnd.choice(words) for _ in range(30)), f"q{k:03d}") for d in range(n_docs)]
    return docs


def test_every_language_is_learnt(spark):
    docs = many(80, 12)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.language_id(df).collect()}
    assert len(got) == len(docs)
    held = [lang == got[i].lang_pred for i, _, lang in docs if got[i].held_out]
    assert len({got[i].lang_pred for i, _, _ in docs}) == 80 and len(held) > 100 and sum(held) >= 0.98 * len(held)


def test_blocks_that_are_not_held_give_the_same_model(monkeypatch):
    docs = many(3, 400)
    one = langid.train([t for _, t, _ in docs], ["en", "de", "fr"] * 400)
    monkeypatch.setattr(langid, "HELD", 0)
    two = langid.train([t for _, t, _ in docs], ["en", "de", "fr"] * 400)
    assert (one.weights == two.weights).all() and one.pairs == [(0, 1)]


def test_rows_without_a_letter_do_not_use_up_the_sample(spark):
    docs = [(k, ("le chat noir" if k % 50 == 7 else None if k % 2 else "12 !"), "fr") for k in range(400)] + [(500 + k, "the dog runs", "en") for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    want = df.where(~langid.held_out(langid.F.col("doc_id"), 4, 2)).where("text = 'le chat noir'").count()
    assert want > 2
    found = langid.training_rows(df, 3)
    assert [c for _, c in found] == ["en"] * 3 + ["fr"] * 3


def test_the_stage_keeps_texts_when_nothing_can_be_learnt(spark):
    docs = [(1, "the dog", None), (2, "le chien", None), (3, "12 !", None), (4, None, None), (5, "", None), (None, "été", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = corpus_pipeline.language_id(spark, df, "")
    assert got.columns == df.columns and sorted(r.text for r in got.collect()) == ["le chien", "the dog", "été"]
