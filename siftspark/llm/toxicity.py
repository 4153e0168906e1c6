"""Toxicity by a weighted finite-state grammar over matched clauses.

The insult transducer is learned: word stems that toxic texts have far more often than
others, with their log rate ratio as weight. Stems come from a bounded sample of labelled
documents (`max_toxic`, `max_clean`; the rows with the smallest hashes), counted by Spark, near copies
once. Fixed word lists give the transducers for persons, negation, verbs of saying and of harm.
Only clauses with a hit are read; the composed machine turns their tokens into weights: an insult
counts its stem's weight, less if denied or quoted, and a person in the clause or a threat adds
to it. A document's clause weights, added up, become a probability by a logistic fit on the sample.

Defined results: NULL and empty texts have no clause and get the score of clean text; rows
repeated whole are scored alike; without labelled toxic rows no stem is learned and only threats
count; an empty table gives no rows. Labels, lang, source and doc_id are not looked at in a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm import grammar
from siftspark.llm.common import held_out, slices, staged, text_of, words_of

# Function words of four languages that the transducers listen to.
PERSONS = "you your yours he she they him her them du dich dir ihr euch sie tu te toi vous lui eux usted ustedes ti".split()
NEGATIONS = "not no never isn't aren't nicht kein keine nie ne pas jamais nunca tampoco".split()
SAYINGS = "said says say saying told wrote quoted called sagte sagt schrieb dit disait dijo dice escribió".split()
HARMS = "kill hurt destroy beat stab shoot töten umbringen tuer frapper matar golpear".split()
FACTORS = {
    grammar.INSULT: 1.0,
    grammar.DENIED: 0.6,
    grammar.QUOTED: 0.7,
    grammar.BOTH: 0.5,
}
STEM_LENGTHS = range(3, 11)
TOKEN = re.compile(r"[\w']+")
CLAUSE_END = re.compile(r"[.!?;:\n]")


@dataclass(frozen=True)
class Model:
    stems: dict[str, float]
    bias: float
    slope: float


class Scorer:
    """Reads one text at a time; made once per task from the model."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.machine = grammar.clause_machine()
        self.classes = {}
        for words, symbol in (
            (PERSONS, grammar.TARGET),
            (NEGATIONS, grammar.NEGATION),
            (SAYINGS, grammar.REPORT),
            (HARMS, grammar.HARM),
        ):
            self.classes.update(dict.fromkeys(words, symbol))
        ends = [f"{re.escape(w)}(?!\\w)" for w in HARMS]
        starts = [re.escape(s) for s in sorted(stems, key=len, reverse=True)]
        self.hit = re.compile(r"(?<!\w)(?:" + "|".join(starts + ends) + ")")

    def classify(self, token: str) -> tuple[str, float]:
        known = self.classes.get(token)
        if known is None:
            for n in STEM_LENGTHS:
                weight = self.stems.get(token[:n])
                if weight is not None:
                    return grammar.INSULT, weight
        return known or grammar.OTHER, 0.0

    def clause(self, text: str) -> float:
        state, total = self.machine.start, 0.0
        for token in TOKEN.findall(text):
            symbol, strength = self.classify(token)
            state, out, weight = self.machine.step(state, symbol)
            total += weight
            if symbol == grammar.INSULT:
                total += strength * FACTORS[out]
        return total

    def __call__(self, text: str | None) -> float:
        """The weight of all matched clauses of a text."""
        text, total, read = (text or "").lower(), 0.0, 0
        while True:
            found = self.hit.search(text, read)
            if found is None:
                return total
            start = read
            for end in CLAUSE_END.finditer(text, read, found.start()):
                start = end.end()
            end = CLAUSE_END.search(text, found.end())
            read = end.end() if end else len(text)
            total += self.clause(text[start:read])


def sample_of(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], held=held_out) -> DataFrame:
    """doc_id, text, y of at most `most[y]` labelled rows that models may learn from, by hash.

    Rows of one text, and most near copies, count once: they share their smallest 3-word shingle.
    """
    known = labels.filter(~held(F.col("doc_id"))).select("doc_id", F.col(label).alias("y"))
    chosen = None
    for y, n in most.items():
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most the sum of `most` rows of two numbers.
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    words = words_of(F.col("text"))
    last = F.greatest(F.size("_w") - 2, F.lit(1))
    shingles = F.transform(
        F.sequence(F.lit(0), last - 1),
        lambda i: F.xxhash64(
            F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)
        ),
    )
    return (
        rows.withColumn("_w", words)
        .withColumn("_mark", F.array_min(shingles))
        .groupBy("_mark", "y")
        .agg(F.min_by(F.struct("doc_id", "text"), "doc_id").alias("_row"))
        .select("_row.doc_id", "_row.text", "y")
    )


def stem_counts(rows: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """stem, docs, tokens over the rows' texts; each task adds up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, tokens = Counter(), Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                found = Counter()
                for word, n in Counter(TOKEN.findall((text or "").lower())).items():
                    for size in STEM_LENGTHS:
                        stem = word[:size]
                        if len(stem) == size and (only is None or stem in only):
                            found[stem] += n
                tokens.update(found)
                docs.update(found.keys())
        stems = list(docs)
        yield pa.RecordBatch.from_pydict(
            {
                "stem": pa.array(stems, pa.string()),
                "docs": pa.array([docs[s] for s in stems], pa.int64()),
                "tokens": pa.array([tokens[s] for s in stems], pa.int64()),
            }
        )

    counted = rows.select("text").mapInArrow(count, "stem string, docs long, tokens long")
    return counted.groupBy("stem").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def learn_stems(
    sample: DataFrame, min_share: float = 0.004, min_docs: int = 4, min_g2: float = 40, most: int = 2000
) -> dict[str, float]:
    """Stems far more frequent in toxic text; of nested ones, the one that tells most."""
    sizes = sample.groupBy("y").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")
    )
    total = {r["y"]: r for r in sizes.collect()}
    if 1 not in total or 0 not in total:
        return {}
    floor = max(min_docs, min_share * total[1]["docs"])
    toxic = {
        r["stem"]: r
        for r in stem_counts(sample.filter("y = 1")).filter(F.col("docs") >= floor).collect()
    }
    clean = {
        r["stem"]: r
        for r in stem_counts(sample.filter("y = 0"), frozenset(toxic)).collect()
    }
    n1, n0 = total[1]["words"], total[0]["words"]
    ranked = []
    for stem, row in toxic.items():
        a, b = row["tokens"], clean[stem]["tokens"] if stem in clean else 0
        b_docs = clean[stem]["docs"] if stem in clean else 0
        ratio = (a / n1) / ((b + 0.5) / n0)
        spread = (row["docs"] / total[1]["docs"]) / ((b_docs + 0.5) / total[0]["docs"])
        if ratio < 10 or spread < 10:
            continue
        both = (a + b) / (n1 + n0)
        g2 = 2 * a * math.log(a / n1 / both) + (2 * b * math.log(b / n0 / both) if b else 0)
        if g2 >= min_g2:
            ranked.append((g2, len(stem), stem, math.log(ratio)))
    chosen: dict[str, float] = {}
    for _, _, stem, weight in sorted(ranked, key=lambda x: (-x[0], x[1], x[2])):
        if not any(stem.startswith(s) or s.startswith(stem) for s in chosen):
            chosen[stem] = round(weight, 6)
        if len(chosen) == most:
            break
    return chosen


def clause_weights(rows: DataFrame, stems: dict[str, float], keep: list[str]) -> DataFrame:
    """The kept columns and `_weight`, the sum over a text's matched clauses."""
    names = [f.name for f in rows.select(*keep).schema]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(stems)
        for batch in slices(batches):
            weights = [scorer(cell.as_py()) for cell in batch["text"]]
            columns = [batch[c] for c in names] + [pa.array(weights, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_weight"])

    inputs = rows.select(*keep) if "text" in keep else rows.select(*keep, "text")
    schema = rows.select(*keep).schema.add("_weight", "double")
    return inputs.mapInArrow(score, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of y on x with a little ridge, by Newton steps."""
    design = np.stack([np.ones_like(x), x], 1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (w * (y - p)) - 0.01 * beta
        curve = (design * (w * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(beta[0]), float(beta[1])


def learn(
    docs: DataFrame, labels: DataFrame, max_toxic: int = 2000, max_clean: int = 4000, label: str = "toxic"
) -> Model:
    sample = staged(sample_of(docs, labels, label, {1: max_toxic, 0: max_clean}), "toxic-sample")
    stems = learn_stems(sample)
    # Two numbers a sampled row.
    seen = clause_weights(sample, stems, ["y"]).collect()
    y = np.array([float(r["y"]) for r in seen])
    if not 0 < y.sum() < len(y):
        return Model(stems, -3.0, 1.0)
    x = np.log1p([r["_weight"] for r in seen])
    share = labels.filter(~held_out(F.col("doc_id"))).agg(F.avg(F.col(label))).first()[0]
    w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(stems, *fit_logistic(x, y, w))


def score_toxicity(
    docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score"
) -> DataFrame:
    """The kept columns (all, unless named) and the probability of being toxic as `name`."""
    weighed = clause_weights(docs, model.stems, docs.columns if keep is None else keep)
    logit = F.lit(model.bias) + F.lit(model.slope) * F.log1p("_weight")
    return weighed.withColumn(name, 1 / (1 + F.exp(-logit))).drop("_weight")
