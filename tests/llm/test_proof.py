"""Operators without SQL: held-out quality in figures, ownership and divergence by brute force."""

import collections
import hashlib
import math
import os
import re

import pytest
from pyspark.sql import functions as F

from siftspark.llm import quality_rules, secrets
from siftspark.llm.common import let, words_of
from siftspark.llm.queries import QUERIES

SMALL, LABELLED = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def auc(scored):
    """The share of (1, 0) pairs in which the 1 has the higher score; ties count half."""
    ranked, below, wins = collections.defaultdict(lambda: [0, 0]), 0, 0.0
    for score, label in scored:
        ranked[score][label] += 1
    for score in sorted(ranked):
        zeros, ones = ranked[score]
        wins += ones * (below + zeros / 2)
        below += zeros
    return wins / (below * (len(scored) - below))


@needs_tables
@pytest.mark.parametrize(
    "name, label, wanted, precision, recall, area",
    [
        # The rarer class is the one to be found: bad documents, and toxic ones.
        ("op2_ftrl_quality", "quality", 0, 0.95, 0.95, 0.99),
        ("op8_pattern_toxicity", "toxic", 1, 0.95, 0.85, 0.94),
    ],
)
def test_held_out_precision_recall_and_auc(spark, name, label, wanted, precision, recall, area):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    held = QUERIES[name](spark, LABELLED).filter("held_out").join(labels, "doc_id")
    rows = [(r.score, r[label], r.predicted) for r in held.select("score", label, "predicted").collect()]
    hits = sum(p == wanted == y for _, y, p in rows)
    assert len(rows) > 500
    assert hits >= precision * sum(p == wanted for _, _, p in rows)
    assert hits >= recall * sum(y == wanted for _, y, _ in rows)
    assert auc([(s, y) for s, y, _ in rows]) >= area


@needs_tables
def test_base_spans_of_secrets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in QUERIES["op6_secret_ownership"](spark, SMALL).collect()}
    kinds = [
        ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
        ("access", r"(AKIA[A-Z0-9]+)", 20),
        ("hex", r"([0-9a-f]+)", 24),
    ]
    for doc in docs:
        spans = [
            (m.start(), k, m.end())
            for k, (_, pattern, least) in enumerate(kinds)
            for m in re.finditer(pattern, doc.text or "")
            if len(m[1]) >= least
        ]
        listed = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
        r, counts = found[doc.doc_id], collections.Counter(kinds[k][0] for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[k[0]] for k in kinds), doc.doc_id
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), doc.doc_id


def test_owners_separate_examples_from_live_values(spark):
    keys = {n: hashlib.sha256(f"key {n}".encode()).hexdigest() for n in (1, 3, 4, 6)}
    alike = {n: f"Zq{n}xW9vB7nM4kJ2hG5fD8s" for n in (1, 3, 4, 6)}
    rows, doc = [], 0
    for n, key in keys.items():
        for owner in range(n):
            for copy in range(3):
                name = None if owner == 2 else f"o{owner}"
                rows.append((doc, f"a {key} b {alike[n]} c", name, f"r{copy}", n))
                doc += 1
    rows += [(doc, None, "o0", None, 0), (doc + 1, "nothing here", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, org string, repo string, n int")
    found = secrets.scan_secrets(docs.repartition(5), owner="org", repository="repo").collect()
    spans = {r.doc_id: r.spans for r in found}
    assert len(found) == len(rows)
    for doc_id, text, _, _, n in rows:
        kinds = [(s.kind, s.start, s.end, s.owners, s.repositories, s.live) for s in spans[doc_id]]
        at = text.index(" b ") if n else 0
        wanted = [("hex", 2, at, n, 3, n <= 3)] if n else []
        if 0 < n <= 3:
            wanted.append(("lookalike", at + 3, len(text) - 2, n, 3, True))
        assert kinds == wanted, (doc_id, n)
    values = secrets.ownership(secrets.candidates(docs, "org", "repo")).collect()
    assert sorted((v.owners, v.repositories, v.copies, v.live) for v in values) == sorted(
        (n, 3, 3 * n, n <= 3) for n in keys for _ in ("hex", "lookalike")
    )
    masked = secrets.redact(docs.withColumn("source", F.col("org"))).collect()
    for r in masked:
        shown = {0: r.text, 1: "a <SECRET> b <SECRET> c", 3: "a <SECRET> b <SECRET> c"}
        assert r.text == shown.get(r.n, f"a <EXAMPLE> b {alike.get(r.n)} c")


def js_distance(a, b):
    if not sum(a) or not sum(b):
        return None
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    mid = [(x + y) / 2 for x, y in zip(p, q)]
    part = lambda r: sum(x * math.log2(x / m) for x, m in zip(r, mid) if x)
    return math.sqrt(max(0.0, (part(p) + part(q)) / 2))


def judged_by_hand(docs, common=20):
    words, by_lang = {}, collections.defaultdict(collections.Counter)
    for k, (_, lang, text) in enumerate(docs):
        words[k] = WORD.findall(text or "")
        by_lang[lang].update(words[k])
    top = {lang: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:common]] for lang, c in by_lang.items()}
    classes, places = {}, {}
    for k, (_, lang, text) in enumerate(docs):
        solid = "".join(words[k])
        known = [len(re.findall(p, text or "")) for p in quality_rules.CLASSES.values()]
        classes[k] = [*known, len(text or "") - len(solid), len(solid) - sum(known)]
        held = collections.Counter(words[k])
        inside = [held[w] for w in top[lang]] + [0] * (common - len(top[lang]))
        places[k] = [len(words[k]) - sum(inside), *inside]
    sums = [{}, {}]
    for k, (_, lang, _) in enumerate(docs):
        for total, own in zip(sums, (classes[k], places[k])):
            total[lang] = [x + y for x, y in zip(total.get(lang, [0] * len(own)), own)]
    for k, (_, lang, _) in enumerate(docs):
        yield js_distance(classes[k], sums[0][lang]), js_distance(places[k], sums[1][lang])


def check_divergence(spark, docs):
    df = spark.createDataFrame([(k, lang, text) for k, (_, lang, text) in enumerate(docs)], "doc_id long, lang string, text string")
    found = {r.doc_id: r for r in quality_rules.judge_quality(df).collect()}
    assert len(found) == len(docs)
    for k, (by_class, by_word) in enumerate(judged_by_hand(docs)):
        r, text = found[k], docs[k][2] or ""
        for got, wanted in ((r.class_distance, by_class), (r.word_distance, by_word)):
            assert (got is None) == (wanted is None) and (wanted is None or abs(got - wanted) < 1e-6), k
        odd = (len(text) >= 250 and by_class > 0.3) or (r.n_words >= 100 and by_word > 0.36)
        assert r.kept == (not r.base_failed and not odd), k
    return found


@needs_tables
def test_divergence_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text").collect()
    check_divergence(spark, [tuple(r) for r in docs])


def test_long_words_can_be_common_and_odd_texts_go(spark):
    plain = [" ".join(f"nevertheless w{(7 * k + i) % 90} because" for i in range(60)) for k in range(12)]
    shouted = " ".join(f"A{i}B{i * 7}!" for i in range(120))
    foreign = " ".join(f"term{i * 31}" for i in range(120))
    docs = [(0, "en", t) for t in plain] + [(0, "en", shouted), (0, "en", foreign), (0, None, plain[0]), (0, "en", None)]
    found = check_divergence(spark, docs)
    assert [found[k].kept for k in range(16)] == [True] * 12 + [False, False, True, False]


@pytest.mark.parametrize("values", [1, 3, 1 << 40])
def test_windows_whose_hashes_clash_are_told_apart(spark, values):
    texts = ["a b c x a b c y a b c", "a b c d e f a c b a", "a a a a b a a a", "a b", "", "p q r s " * 9, "k l m n o k l m z m n o"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")

    def hashed(*words):
        return F.pmod(F.xxhash64(*words), F.lit(values))

    df = df.withColumn("_words", let(F.col("text"), words_of))
    df = df.withColumn("_windows", F.sort_array(quality_rules.packed_windows(F.col("_words"), hashed)))
    n = quality_rules.repeated_words(F.col("_words"), F.col("_windows"))
    for r in df.select("doc_id", n.alias("n")).collect():
        words = texts[r.doc_id].split()
        windows = list(zip(words, words[1:], words[2:]))
        under = {k + i for k, w in enumerate(windows) if windows.count(w) > 1 for i in range(3)}
        assert r.n == len(under), texts[r.doc_id]
