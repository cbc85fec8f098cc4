"""The pipeline against a brute-force version of its stages on a small corpus."""

from collections import Counter

import corpus_pipeline
from barline.llm import mixing, registry

from . import brute

BENCH = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"


def small(spark, tmp_path):
    passage = " ".join(f"word{k % 7}" for k in range(51))
    unique = lambda n, m: " ".join(f"u{n}x{k}" for k in range(m))
    docs = [
        (1, unique(1, 80)), (2, unique(1, 80) + " tail"), (3, "12 34 !!"), (4, None), (5, unique(5, 50) + " " + passage + " " + unique(55, 50)), (6, unique(6, 70) + " " + passage + " " + unique(66, 9)),
        (7, unique(7, 30) + " " + BENCH + " " + unique(77, 30)), (8, unique(8, 60)),
    ]
    docs += [(k, unique(k, 30 + k)) for k in range(20, 50)]
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 2}", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def test_stages_in_order(spark, tmp_path):
    docs = small(spark, tmp_path)
    texts = {i: t for i, t in docs if t and any(c.isalpha() for c in t)}
    lead = brute.jaccard(list(texts.items()))
    texts = {i: t for i, t in texts.items() if lead[i][1] == i}
    bodies = {i: t.encode() for i, t in texts.items()}
    count: dict[bytes, int] = {}
    for b in bodies.values():
        for p in range(len(b) - 255):
            count[b[p : p + 256]] = count.get(b[p : p + 256], 0) + 1
    for i, b in bodies.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 255):
            if count[b[p : p + 256]] > 1:
                gone[p : p + 256] = b"\1" * 256
        texts[i] = bytes(x for x, g in zip(b, gone) if not g).decode()
    texts = {i: t.replace(BENCH, "") for i, t in texts.items()}

    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = df.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        df = stage(spark, df, str(tmp_path))
        assert df.columns == columns, name
        df.write.parquet(f"{tmp_path}/out{k}")
        df = spark.read.parquet(f"{tmp_path}/out{k}")
    got = {r.doc_id: r for r in df.collect()}
    assert {i: r.text for i, r in got.items()} == texts
    assert all(r.n_chars == len(r.text) for r in got.values())
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    found = mixed.collect()
    assert mixed.columns == columns and all(texts[r.doc_id] == r.text for r in found)
    # A document stands there as often as the words that the mix takes of it are its size.
    taken = {r.doc_id: r.taken // r.size for r in mixing.mixed(df).collect() if r.taken}
    assert Counter(r.doc_id for r in found) == taken and max(taken.values()) > 1


def test_stages_take_an_empty_table(spark, tmp_path):
    small(spark, tmp_path)
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "decontaminate", "mix_sources"]
    assert set(registry.oracle_sql()) <= set(registry.queries())
