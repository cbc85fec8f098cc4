"""Very long texts, and columns whose names operators use inside, against plain versions."""

import random

from pyspark.sql import functions as F

from barline.llm import chat, decontaminate, fingerprints, licenses, ngram_join, substring_dedup, suffix_dedup

from . import brute

CLASH = ("sid", "keys", "bucket", "home", "tuples", "license", "fingerprint", "part", "wrapped", "kept_text")


def clashing(spark, docs):
    df = brute.frame(spark, docs)
    return df.select("*", *[F.lit("c").alias(c) for c in CLASH])


def long_docs(words=60_000, seed=9):
    rnd = random.Random(seed)
    text = [rnd.choice("abcdefgh") * rnd.randint(1, 6) + str(rnd.randint(0, 300)) for _ in range(words)]
    near = list(text)
    for _ in range(words // 500):
        near[rnd.randrange(words)] = "changed"
    tail = " ".join(text[-3000:])
    return [(1, " ".join(text)), (2, " ".join(near)), (3, "short"), (4, tail), (5, None), (6, ""), (7, ". ".join(" ".join(text[k : k + 12]) for k in range(0, words // 2, 12)))]


def rows(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


def test_words_of_long_texts(spark):
    docs = long_docs()
    frame = clashing(spark, docs)
    assert rows(substring_dedup.substring_dedup(frame), "n_words", "n_removed", "kept_sha256") == brute.substring(docs)
    got = rows(ngram_join.jaccard_components(frame), "n_shingles", "component_id")
    assert got == brute.jaccard(docs) and got[2][1] == 1
    items = [(1, " ".join(docs[0][1].split()[100:130])), (2, "short")]
    found = decontaminate.decontaminate(frame, spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rid string"))
    assert rows(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute.leaks(docs, items)


def test_bytes_and_paragraphs_of_long_texts(spark):
    docs = long_docs(6000)
    frame = clashing(spark, docs)
    assert rows(suffix_dedup.remove_repeats(frame), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix(docs)
    texts = {i: t or "" for i, t in docs}
    for r in fingerprints.fingerprint_versions(frame).collect():
        following = texts[r.doc_id % 7 + 1]
        half = len(texts[r.doc_id]) // 2
        edited = texts[r.doc_id][: len(texts[r.doc_id]) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(texts[r.doc_id]), brute.sha(edited))
        assert abs(r.near_edited - brute.likeness(texts[r.doc_id], edited)) < 1e-12 and abs(r.near_next - brute.likeness(texts[r.doc_id], following)) < 1e-12


def test_a_notice_in_a_long_text(spark):
    body = " ".join(f"w{k % 997}" for k in range(60_000))
    docs = [(1, body), (2, body + "\nReleased under the MIT License.\n" + body)]
    got = {r.doc_id: (r.license, r.unit) for r in licenses.license_scan(clashing(spark, docs)).collect()}
    assert got == {1: (None, None), 2: ("MIT", "line")}


def test_a_long_turn(spark):
    text = "word </turn> " * 60_000
    rows_ = [(1, 0, "user", "hi"), (1, 1, "assistant", text), (2, 0, "user", None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows_], "conv_id long, turn long, role string, text string, segments string, n_turns int")
    got = {r.conv_id: r for r in chat.digest_conversations(chat.format_conversations(df)).collect()}
    assert got[1].loss_chars == len(text) and got[1].loss_sha256 == brute.sha(text) and got[1].turns_sha256 == brute.sha(f"user\nhi\nassistant\n{text}\n")
    assert got[2].n_turns == 1 and got[2].loss_chars == 0
