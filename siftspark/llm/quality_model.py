"""Quality classifier: hashed word n-grams, FTRL-proximal logistic regression.

Each word gives two symbols, its letters in lower case and its shape (case and marks). Unigrams and
bigrams of both, and immediate repeats, are hashed into 2^18 buckets; a bucket's value is its count over
the number of words, times a scale, so texts of any length weigh alike. The score is a sparse dot
product: a gather from the weight table, summed.

Training takes at most `max_rows` labelled rows (those with the smallest hashes), dealt over a
fixed number of shards. In each round every shard runs the updates of follow-the-regularised-
leader from the mean state of the last round, and Spark averages the shards' states by bucket. The driver holds one
state: 2^18 rows of two numbers, whatever the input.

Defined results: NULL and empty texts have no n-gram and score by the bias alone; repeated rows
score alike; without labelled rows of both kinds all weights are 0 and every score is 0.5; an
empty table gives no rows. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import held_out, slices, staged, text_of

BITS = 18
BIAS = 1 << BITS  # its own slot after the buckets
SCALE = 24.0
# Odd multipliers that keep the families of n-grams apart.
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
FINAL = np.uint64(0xFF51AFD7ED558CCD)
REPEAT_SLOT = 0x2A5F7
LETTERS = re.compile(r"\w+")


class Symbols(dict):
    """word -> 64 bits: the hash of its letters, then the hash of its shape. Bounded."""

    limit = 300_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        runs = LETTERS.findall(word)
        core = "".join(runs)
        case = "0" if core.isdigit() else "A" if core.isupper() and len(core) > 1 else "Aa" if core[:1].isupper() else "a"
        marks = LETTERS.sub("w", word)[:8]
        found = zlib.crc32(core.lower().encode()) << 32 | zlib.crc32(f"{case} {marks}".encode())
        self[word] = found
        return found


class Features:
    """Buckets of a text's n-grams, with repeats, and the number of words."""

    def __init__(self):
        self.symbols = Symbols()

    def __call__(self, text: str | None) -> tuple[np.ndarray, int]:
        words = (text or "").split()
        if not words:
            return np.zeros(0, np.int64), 0
        look = self.symbols
        both = np.array([look[w] for w in words], np.uint64)
        core, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        grams = [core * MIX[0], shape * MIX[1]]
        if len(words) > 1:
            grams.append(core[:-1] * MIX[2] + core[1:] * MIX[0])
            grams.append(shape[:-1] * MIX[3] + shape[1:] * MIX[1])
        mixed = np.concatenate(grams)
        mixed ^= mixed >> np.uint64(29)
        buckets = ((mixed * FINAL) >> np.uint64(64 - BITS)).astype(np.int64)
        repeats = int((core[:-1] == core[1:]).sum())
        if repeats:
            buckets = np.concatenate([buckets, np.full(repeats, REPEAT_SLOT, np.int64)])
        return buckets, len(words)


@dataclass(frozen=True)
class Rate:
    """FTRL-proximal's parameters."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


def weights_of(z: np.ndarray, n: np.ndarray, rate: Rate) -> np.ndarray:
    shrunk = np.sign(z) * rate.l1 - z
    return np.where(np.abs(z) <= rate.l1, 0.0, shrunk / ((rate.beta + np.sqrt(n)) / rate.alpha + rate.l2))


def train_shard(rows: list[tuple[np.ndarray, int, int]], z: np.ndarray, n: np.ndarray, rate: Rate) -> None:
    """One pass of updates over (buckets, words, y), in place."""
    for buckets, words, y in rows:
        index, count = np.unique(buckets, return_counts=True)
        index = np.append(index, BIAS)
        value = np.append(count * (SCALE / max(words, 1)), 1.0)
        w = weights_of(z[index], n[index], rate)
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ value)))))
        g = (p - y) * value
        sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / rate.alpha
        z[index] += g - sigma * w
        n[index] += g * g


def _shard_runner(state, rate: Rate):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = (a.copy() for a in state.value)
        features = Features()
        rows = rows.sort_values(["doc_id", "text"])
        order = np.random.default_rng(7).permutation(len(rows))
        texts, ys = rows["text"].to_numpy()[order], rows["y"].to_numpy()[order]
        train_shard([(*features(t), y) for t, y in zip(texts, ys)], z, n, rate)
        used = np.flatnonzero(n)
        return pd.DataFrame({"bucket": used, "z": z[used], "n": n[used]})

    return run


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_rows: int = 16_000,
    shards: int = 8,
    rounds: int = 4,
    rate: Rate = Rate(),
) -> np.ndarray:
    """The weight table: 2^18 buckets and the bias."""
    known = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("y"))
    chosen = known.filter("y IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # At most max_rows rows of two numbers are broadcast.
    sample = staged(
        docs.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards))),
        "quality-sample",
    )
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    context = docs.sparkSession.sparkContext
    for _ in range(rounds):
        state = context.broadcast((z, n))
        mean = (
            sample.groupBy("shard")
            .applyInPandas(_shard_runner(state, rate), "bucket long, z double, n double")
            .groupBy("bucket")
            .agg(F.avg("z").alias("z"), F.avg("n").alias("n"))
            .toPandas()
        )
        z[mean["bucket"]], n[mean["bucket"]] = mean["z"], mean["n"]
        state.unpersist()
    return weights_of(z, n, rate).astype(np.float32)


def score_quality(
    docs: DataFrame, weights: np.ndarray, keep: list[str] | None = None, name: str = "score"
) -> DataFrame:
    """The kept columns (all, unless named) and as `name` the probability of label 1, which takes the
    place of a column of that name."""
    keep = [c for c in keep or docs.columns if c.lower() != name.lower()]
    table = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(), table.value
        for batch in slices(batches):
            scores = []
            for cell in batch["text"]:
                buckets, words = features(cell.as_py())
                logit = float(w[BIAS]) + SCALE * float(w[buckets].sum()) / max(words, 1)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))))
            columns = [batch[c] for c in keep] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, name])

    inputs = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    return inputs.mapInArrow(score, docs.select(*keep).schema.add(name, "double"))
