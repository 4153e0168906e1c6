"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools

import corpus_pipeline
import pytest
from conftest import BASE, LONG, rows
from pyspark.sql import functions as F

from siftspark.llm import jaccard, mixture, quality_model, quality_rules, secrets, suffix_dedup, toxicity
from siftspark.llm.decontaminate import find_passages, remove_contaminated


def empty(df):
    return df.filter(F.lit(False))


def test_decontaminate(docs, benchmark):
    found = find_passages(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (6, 1)}
    assert {r.best_window for r in found} == {12}
    left = remove_contaminated(docs, benchmark)
    assert left.columns == docs.columns and left.count() == docs.count() - 4
    assert find_passages(empty(docs), benchmark).count() == 0
    assert find_passages(docs, empty(benchmark)).count() == 0


def test_decontaminate_bears_two_substitutions_in_twelve(spark, benchmark):
    words = BASE.split()[3:20]
    for changed, hit in (((4, 9), True), ((1, 6, 11), True), ((1, 4, 7, 10, 13), False)):
        text = " ".join("zz" if i in changed else w for i, w in enumerate(words))
        docs = spark.createDataFrame([(1, "aa bb " + text + " cc")], "doc_id long, text string")
        assert (find_passages(docs, benchmark).count() == 1) == hit, changed


def test_decontaminate_finds_short_items_with_every_allowed_substitution(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13)}
    texts, expected = [], set()
    for n, words in items.items():
        for k in range(4):
            for changed in itertools.combinations(range(n), k):
                for frame in ("", "aa bb cc "):
                    text = frame + " ".join("zz" if i in changed else w for i, w in enumerate(words))
                    windows = [range(at, min(at + 12, n)) for at in range(max(1, n - 11))]
                    best = max(sum(i not in changed for i in w) for w in windows)
                    if n >= 5 and best * 12 >= min(n, 12) * 10:
                        expected.add((len(texts), n, best))
                    texts.append((len(texts), text))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = find_passages(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.best_window) for r in found} == expected
    assert {n for _, n, _ in expected} == set(range(5, 14))
    with pytest.raises(ValueError, match="masks"):
        find_passages(docs, benchmark, window=8, min_matches=6)


def test_quality_model(docs, labels):
    weights = quality_model.learn(docs, labels, max_rows=6, shards=2, rounds=2)
    scored = quality_model.score_quality(docs, weights, ["doc_id"]).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (1, 6)}) == 1
    flat = quality_model.learn(docs, empty(labels))
    assert {r.score for r in quality_model.score_quality(docs, flat, ["doc_id"]).collect()} == {0.5}
    assert quality_model.score_quality(empty(docs), flat, ["doc_id"]).count() == 0


def test_toxicity(docs, labels):
    model = toxicity.learn(docs, labels)
    scored = toxicity.score_toxicity(docs, model)
    assert sorted(scored.columns) == sorted(docs.columns)
    assert scored.count() == docs.count()
    bare = toxicity.learn(docs, empty(labels))
    assert bare.stems == {}
    assert toxicity.score_toxicity(empty(docs), bare, ["doc_id"]).count() == 0


def test_quality_rules(docs):
    judged = {(r.doc_id, r.n_words): r for r in quality_rules.judge_quality(docs).collect()}
    assert judged[1, len(BASE.split())].n_repeat_words == 0 and judged[3, 0].base_failed
    assert judged[7, 40000].n_repeat_words == 40000 and judged[7, 40000].base_failed
    assert judged[5, 0].word_chars == 0 and judged[None, 3].base_failed
    assert quality_rules.judge_quality(empty(docs)).count() == 0


def test_secrets(docs):
    scanned = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    assert [s.kind for s in scanned[9].spans] == ["assign", "hex"]
    assert all(not r.spans for i, r in scanned.items() if i != 9)
    masked = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert masked[9] == '<SECRET>" \\ end' and masked[1] == BASE and masked[3] is None
    assert secrets.redact(docs).columns == docs.columns
    assert secrets.scan_secrets(empty(docs)).count() == 0


def test_mixture(docs):
    taken = mixture.mixture(docs)
    by_source = {
        r.source: r for r in taken.groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("n"), F.max("source_size").alias("size")).collect()
    }
    assert set(by_source) == {"a", "b", None}
    for r in by_source.values():
        assert r.n == round(r.target) <= 3 * r["size"]
    assert sum(r.n for r in by_source.values()) == sum(len((r[1] or "").split()) for r in rows())
    again = mixture.mixture(docs.repartition(5))
    key = lambda df: sorted(map(str, df.select("doc_id", "taken").collect()))
    assert key(again) == key(taken)
    mixed = mixture.mixed_rows(docs)
    assert mixed.columns == [*[c for c in docs.columns if c not in ("epoch", "words")], "epoch", "words"]
    wrong = [r for r in mixed.collect() if r.words != len((r.text or "").split())]
    assert not wrong
    assert mixture.mixture(empty(docs)).count() == 0


def test_near_copies(docs):
    found = {(r.doc_id, r.component_id) for r in jaccard.similarity_components(docs).collect()}
    # One word apart, 1 and 2 share all but five shingles each: under 0.8.
    assert found == {(1, 1), (2, 2), (6, 1), (7, 7), (3, 3), (4, 4), (5, 5), (8, 8), (9, 9), (None, None)}
    left = jaccard.keep_representatives(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert jaccard.similarity_components(empty(docs)).count() == 0


def test_suffix_dedup(docs):
    found = suffix_dedup.remove_repeats(docs).collect()
    kept = {r.doc_id: r for r in found}
    assert len(found) == docs.count()
    assert kept[1].n_removed == 0 and kept[1].kept == BASE.encode()
    assert kept[6].n_removed == len(BASE) and kept[6].n_spans == 1
    # Both sides of the changed word are longer than a string, so only the word stays.
    assert kept[2].kept == b"dark" and kept[2].n_removed == len(BASE) - 4
    assert kept[7].n_removed == 0 and kept[7].n_bytes == len(LONG)
    assert kept[None].n_removed == 0 and kept[3].n_bytes == 0
    assert hashlib.sha256(kept[4].kept).hexdigest().startswith("e3b0")
    assert suffix_dedup.remove_repeats(empty(docs)).count() == 0


@pytest.mark.parametrize("none", [False, True])
def test_pipeline_stages(spark, docs, labels, benchmark, tmp_path, none):
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        (empty(df) if none else df).write.parquet(f"{tmp_path}/{name}.parquet")
    columns = docs.columns
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == columns, name
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert (result.count() == 0) == none
