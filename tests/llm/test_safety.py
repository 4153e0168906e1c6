"""Inputs that are no plain scans, and ids that name several texts."""

import hashlib

from pyspark.sql import functions as F

from siftspark.llm import suffix_dedup
from siftspark.llm.jaccard import keep_representatives, similarity_components
from siftspark.llm.secrets import redact

SCHEMA = "doc_id long, text string, source string, n_chars long"


def secret(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def test_redact_masks_the_rows_that_hold_secrets(spark):
    rows = [(i, f"key {secret(i)} of {i}" if i % 10 == 0 else f"clean {i}", f"s{i % 7}", 1) for i in range(2000)]
    rows += [(5000, rows[0][1], "s1", 1), (5000, rows[0][1], "s1", 1), (None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = docs.select("doc_id").distinct().withColumn("more", F.lit(1))
    inputs = {
        "shuffled": docs.repartition(8),
        "joined": docs.join(other, docs["doc_id"].eqNullSafe(other["doc_id"])).select(docs["*"]),
        "aggregated": docs.groupBy(*docs.columns).count().drop("count"),
        "sorted": docs.orderBy(F.desc("text")),
    }
    for name, df in inputs.items():
        out = redact(df).collect()
        assert len(out) == (2002 if name == "aggregated" else 2003)
        for r in out:
            was_secret = r["doc_id"] is not None and (r["doc_id"] % 10 == 0)
            want = None if r["doc_id"] is None else f"key <SECRET> of {r['doc_id'] % 5000}" if was_secret else f"clean {r['doc_id']}"
            assert r["text"] == want, name
            assert r["n_chars"] == (None if want is None else len(want) if was_secret else 1)


def test_texts_that_share_an_id_are_told_apart(spark):
    one = " ".join(f"alpha{i}" for i in range(40))
    two = " ".join(f"beta{i}" for i in range(40))
    near = one.replace("alpha39", "other")
    rows = [(7, one), (7, two), (9, near), (3, two + " end"), (8, "lone text of few words here"), (8, "lone text of few words here"),
            (11, ""), (11, ""), (11, " "), (12, ""), (None, "nobody knows the id of these words"), (None, two)]
    kept = keep_representatives(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    expected = [(7, one), (3, two + " end"), (8, rows[4][1]), (11, ""), (11, " "), (12, ""), (None, rows[10][1])]
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, expected))


def test_the_order_of_shingles_changes_no_link(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for group in range(6):
        for copy in range(12):
            words = [f"g{group}{w}" for w in base] + ["common", "line", "that", "all", "documents", "share", "at", "the", "end"]
            words[copy * 5] = f"x{copy}"
            rows.append((group * 100 + copy, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {tuple(r) for r in similarity_components(docs).collect()}
    assert plain == {tuple(r) for r in similarity_components(docs, order_size=8).collect()}
    assert {r[2] for r in plain} == {group * 100 for group in range(6)}


def test_turns_that_are_missing_or_tied_lose_nothing(spark):
    from siftspark.llm import chat

    rows = [
        (1, None, "user", "hello there"), (1, 0, "assistant", "a" * 200), (1, 0, "assistant", "b" * 200),
        (1, 1, "user", "and you"), (1, None, None, None), (2, None, "assistant", "only"), (2, 5, "assistant", "last"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn int, role string, text string, seq string, kind string")
    found = {r["conv_id"]: r for r in chat.digests(chat.render(chat.fold_events(chat.events_of_rows(df)))).collect()}
    order = [("", ""), ("user", "hello there"), ("assistant", "a" * 200), ("assistant", "b" * 200), ("user", "and you")]
    lines = "".join(f"{role}\n{text}\n" for role, text in order)
    assert found[1]["turns_sha256"] == hashlib.sha256(lines.encode()).hexdigest() and found[1]["n_turns"] == 5
    assert found[1]["loss_chars"] == 400 and found[2]["loss_chars"] == 8
    assert found[2]["loss_sha256"] == hashlib.sha256(b"onlylast").hexdigest()


def test_a_column_named_score_is_replaced(spark):
    import numpy as np

    from siftspark.llm.quality_model import BIAS, score_quality

    weights = np.zeros(max(BIAS + 1, 1 << 20), np.float32)
    df = spark.createDataFrame([(1, "some text", "old", "s"), (2, None, "old", "s")], "doc_id long, text string, Score string, w string")
    out = score_quality(df, weights)
    assert out.columns == ["doc_id", "text", "w", "score"] and {r["score"] for r in out.collect()} == {0.5}
    assert "p" in score_quality(df, weights, name="p").columns and "Score" in score_quality(df, weights, name="p").columns


def test_suffix_dedup_tells_texts_under_one_id_apart(spark):
    shared = "this passage of more than fifty bytes stands in several of the documents here"
    alone = "".join(secret(i) for i in range(4))
    rows = [(1, shared), (7, alone), (7, f"before {shared} after"), (7, f"{alone} {alone[::-1]}"), (8, alone), (9, alone[::-1] + "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], bytes(r["kept"]).decode()) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert found == {
        (1, shared), (7, alone), (7, "before  after"), (7, f"{alone} {alone[::-1]}"), (8, ""), (9, "x"),
    }
    assert {tuple(r) for r in suffix_dedup.remove_repeats(docs.repartition(3)).collect()} == {
        tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()
    }
