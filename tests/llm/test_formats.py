import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from barline.llm import chat, fingerprints, mixing, textkit as tk

from . import brute

TEXT = st.lists(st.sampled_from([*"ab\\#:</>turn \né", "### User: ", "</turn>", "role="]), max_size=12).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "System", "role=user", ""]) | TEXT, TEXT), max_size=6))
def test_chat_reads_back(turns):
    made = chat.format_turns(turns)
    whole = "".join(t for t, _ in made.segments)
    assert chat.read_back(whole) == turns
    assert "".join(chat.unescape(t) for t, loss in made.segments if loss) == "".join(t for r, t in turns if r == "assistant")


def test_chat_machine():
    valid = lambda *roles: chat.format_turns([(r, "x") for r in roles])
    assert valid("system", "user", "assistant").valid and valid("user", "assistant", "user", "assistant").valid
    assert valid("assistant").error == "turn 1: assistant after <start>"
    assert valid("user", "user").error == "turn 2: user after user"
    assert valid("user").error == "turn 2: end after user"
    assert chat.format_turns([(None, None)]).error == "turn 1: no role after <start>"


def test_chat_of_odd_rows(spark):
    rows = [(1, 2, "assistant", "late"), (1, 1, "user", None), (None, 1, "user", "no id"), (2, 1, "user", "a"), (2, 1, "user", "a"), (3, 1, None, "?"), (4, None, "user", "x" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.digest_conversations(chat.format_conversations(df)).collect()}
    assert got[1].valid and got[1].turns_sha256 == brute.sha("user\n\nassistant\nlate\n") and got[1].loss_chars == 4
    assert got[2].n_turns == 2 and not got[2].valid and got[3].error.startswith("turn 1: no role") and got[None].n_turns == 1
    assert chat.format_conversations(df.where("conv_id > 9")).count() == 0


def test_chat_does_not_read_other_columns(spark):
    rows = [(1, 0, "user", "hi", "s", 1, True), (1, 1, "assistant", "yes", "s", 1, True)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string, n_turns long, valid boolean")
    plain = df.select("conv_id", "turn", "role", "text")
    both = [chat.digest_conversations(chat.format_conversations(chat.with_control_strings(x))).orderBy("conv_id").collect() for x in (df, plain)]
    assert both[0] == both[1] and len(both[0]) == 2


def sketch_sets(*texts):
    return fingerprints._digests(list(texts))


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 300), st.integers(0, 300), st.integers(0, 60))
def test_peeling_recovers_the_differences(a, b, both):
    mine = [f"m{k}.\n" for k in range(a)] + [f"b{k}.\n" for k in range(both)]
    theirs = [f"t{k}.\n" for k in range(b)] + [f"b{k}.\n" for k in range(both)]
    left, right = sketch_sets("".join(mine)), sketch_sets("".join(theirs))
    count, parts = fingerprints.differences(left, right)
    assert count.tolist() == [a + b]
    found = {(int(k), int(s)) for _, keys, signs in parts for k, s in zip(keys, signs)}
    want = {(int(k), 1) for k in set(left[0].tolist()) - set(right[0].tolist())} | {(int(k), -1) for k in set(right[0].tolist()) - set(left[0].tolist())}
    assert found == want


def test_fingerprints_are_what_sets_give(spark):
    docs = [(k, t) for k, t in brute.corpus(n=30)] + [(1000, "A. B. C.\nD"), (1001, "A. B. C.\nD"), (1002, "ü. " * 5000)]
    got = {r.doc_id: r for r in fingerprints.fingerprint_versions(brute.frame(spark, docs)).collect()}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(docs):
        t, following = t or "", docs[(k + 1) % len(docs)][1] or ""
        edited = fingerprints.edit(t, following)
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), brute.sha(edited))
        assert abs(got[i].near_edited - brute.likeness(t, edited)) < 1e-9 and abs(got[i].near_next - brute.likeness(t, following)) < 1e-9
    assert got[1000].fingerprint == got[1001].fingerprint


def test_ranges_of_any_number_pair_alike(spark):
    docs = [(k * k, f"text {k}. more.") for k in range(200)] + [(k * k, f"other {k}") for k in range(0, 200, 7)] + [(None, "x"), (None, "y")]
    df = brute.frame(spark, docs, 5)
    seen = []
    for size in (1 << 40, 300, 40):
        part: dict = {}
        for r in fingerprints.next_document(df, size).select(fingerprints.F.spark_partition_id().alias("p"), "*").collect():
            part.setdefault(r.p, []).append(r)
        assert all(len({r.part for r in rows}) == 1 for rows in part.values())
        pairs = [(a.doc_id, a.text, b.doc_id, b.text) for rows in part.values() for a, b in zip(rows, rows[1:]) if not a.wrapped]
        seen.append(sorted(pairs, key=lambda x: (x[0] or -1, x[1])))
        assert len(pairs) == len(docs)
    assert seen[0] == seen[1] == seen[2]


def test_fingerprints_of_few_and_odd_rows(spark):
    one = fingerprints.fingerprint_versions(brute.frame(spark, [(7, "a. b. c. d.")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    odd = fingerprints.fingerprint_versions(brute.frame(spark, [(None, "x"), (1, None), (1, None), (1, "b. c.")])).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in odd) == [(0, 1), (1, 0), (1, 0), (1, 5)]
    assert fingerprints.fingerprint_versions(brute.frame(spark, [(1, "a")]).where("doc_id > 5")).count() == 0


def mixed(spark, docs, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, copies string").repartition(3)
    return mixing.mixed(df, **how).toPandas()


def test_targets_fill_up_to_the_caps():
    """Against sharing out the excess again and again."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    sizes = {"a": 1000, "b": 10, "c": 40, "d": 0, "e": 700, None: 3}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    assert all(abs(got[s] - target[s]) < 1e-9 * max(target[s], 1) for s in sizes)


def test_mix_takes_near_its_targets(spark):
    docs = [(k, " ".join(["w"] * (k % 37)), f"s{k % 4}" if k % 11 else None, "x") for k in range(3000)] + [(None, None, "s1", "x")]
    got = mixed(spark, docs)
    assert len(got) == len(docs) and (got.taken <= 3 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((per.target - per.taken).abs() <= 2 * 37).all()
    again = mixed(spark, docs)
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))


def test_the_order_is_the_same_for_any_number_of_partitions(spark):
    """A source and size with most of the rows, and a row that is repeated, are cut by ranges at any place."""
    docs = [(k * 7 % 400, "a b c", f"s{int(k % 10 == 0)}", "x") for k in range(400)] + [(3, "a b c", "s0", "x")] * 50 + [(None, "a b c", "s0", "x"), (9, "a", None, "x")]
    key, seen = ["doc_id", "size", "taken"], []
    for parts in ("1", "3", "16"):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = mixed(spark, docs)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        per = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
        assert ((per.target - per.taken).abs() <= 3).all()
        seen.append(got[key].sort_values(key).reset_index(drop=True))
    assert seen[0].equals(seen[1]) and seen[0].equals(seen[2])


def test_texts_of_one_doc_id_mix_alike_in_reruns(spark):
    docs = [(k % 3, f"w{k} x", "s1", "x") for k in range(60)] + [(k, "y z", "s2", "x") for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, copies string")
    one, two = (sorted((r.doc_id, r.text) for r in mixing.mix_documents(d).collect()) for d in (df.repartition(2), df.repartition(7)))
    assert one == two


def test_word_counts(spark):
    texts = ["", " ", "a", " a  b\t\nc ", "é è x", "\x0b\x0c", "x" * 1000, "a\x1cb c", None, "w " * 100_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string").select("k", mixing.word_count(df_col("text")).alias("n"))
    assert [r.n for r in df.orderBy("k").collect()] == [len(brute.SPACE_WORD.findall(t or "")) for t in texts]


def df_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_mixed_documents_come_as_often_as_planned(spark):
    docs = [(k, "a " * (k % 5 + 1), f"s{k % 3}", "x") for k in range(90)] + [(1, "a a ", "s1", "x")] * 4
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, copies string")
    plan = mixing.mixed(df, keep=("doc_id", "text", "source")).toPandas()
    want = plan.groupby(["doc_id", "text"]).copies.sum()
    got = mixing.mix_documents(df)
    assert got.columns == df.columns
    counted = got.toPandas().groupby(["doc_id", "text"]).size()
    assert counted.reindex(want.index, fill_value=0).equals(want.astype("int64").rename(None))


def test_no_python_in_the_plan_of_the_mix(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    for made in (mixing.mixed(df), mixing.mix_documents(df)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pieces_cover_a_sliced_column_with_nulls():
    col = pa.array(["ab", None, "é" * 10, "", "x"] * 4).slice(3, 11)
    out = [bytes(p.data[p.offs[k] : p.offs[k + 1]]).decode() for p in tk.pieces(col, 8) for k in range(p.n)]
    assert out == [x or "" for x in col.to_pylist()]
    assert np.array_equal(np.concatenate([np.arange(p.rows.start, p.rows.stop) for p in tk.pieces(col, 8)]), np.arange(11))
