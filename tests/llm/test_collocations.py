"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter
from fractions import Fraction

from siftspark.llm.collocations import collocations, frequent_phrases

SCHEMA = "doc_id long, lang string, text string"


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def expected(rows, support, top=2000):
    out = []
    for lang in {r[1] or "und" for r in rows}:
        f, n = Counter(), 0
        for _, own, text in rows:
            if (own or "und") == lang:
                for words in pieces(text):
                    n += len(words)
                    f.update(tuple(words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        found = []
        for p, a in candidates.items():
            cuts = [(Fraction(1000 * a * n, f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and b >= a and p in {q[i : i + len(p)] for i in range(len(q))}
                for q, b in candidates.items()
            )
            if not inside:
                found.append((" ".join(p), a, f[p[:k]], f[p[k:]], n, score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i + 1, *x) for i, x in enumerate(found[:top])]
    return sorted(out)


def texts(seed, n=60):
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "eps", "é", "ß", "x"]
    for i in range(n):
        body = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", ". ", "\n", ", "]) for _ in range(r.randint(0, 30)))
        yield (i, r.choice(["en", "fr", None]), body)


def test_counts_scores_and_ranks(spark):
    rows = [*texts(1), (100, "en", None), (101, None, ""), (102, "de", " .,;\n"), (103, "en", "a a a a a"), (103, "en", "a a a a a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for support, top in ((2, 2000), (5, 7)):
        found = collocations(docs, support=support, top=top).collect()
        assert sorted(tuple(r) for r in found) == expected(rows, support, top)


def test_border_failures_are_expanded(spark):
    # A sample of next to nothing proposes nothing, one with a high support few: the result is the same.
    rows = list(texts(2, 80))
    docs = spark.createDataFrame(rows, SCHEMA)
    for options in ({"one_in": 1000}, {"one_in": 2, "lowered": 1.5}, {"one_in": 1, "lowered": 0.1}):
        found = collocations(docs, support=6, **options).collect()
        assert sorted(tuple(r) for r in found) == expected(rows, 6)


def test_a_full_bitmap_costs_no_results(spark):
    rows = list(texts(3, 40))
    docs = spark.createDataFrame(rows, SCHEMA)
    plain = {tuple(r) for r in frequent_phrases(docs, support=4).collect()}
    assert plain == {tuple(r) for r in frequent_phrases(docs, support=4, most_bits=1 << 20, one_in=3).collect()}
    assert all(n >= 4 or m == 0 for _, m, _, n in plain)


def test_edges(spark, docs):
    found = collocations(docs, support=2)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, 2)
    assert collocations(docs.limit(0), support=2).count() == 0
