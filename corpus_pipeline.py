"""From raw documents to a training mix, in five stages over the operators of siftspark.llm.

Each stage takes (spark, docs, sf_dir) and returns all it keeps, with the columns of documents; the
last one returns the mix. Every stage's result is written as Parquet and read again for the next.

Defined results: NULL texts count as empty and pass the filters; rows repeated whole are
copies, of which one stays; an empty table comes out empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siftspark.llm.common import staged  # noqa: E402
from siftspark.llm.decontaminate import remove_contaminated  # noqa: E402
from siftspark.llm.jaccard import keep_representatives  # noqa: E402
from siftspark.llm.mixture import mixed_rows  # noqa: E402
from siftspark.llm.secrets import redact  # noqa: E402
from siftspark.llm.toxicity import learn, score_toxicity  # noqa: E402

#: What the contract of the toxicity query takes as toxic.
TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose matched clauses make them less likely toxic than not."""
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model, name="_toxicity")
    return scored.filter(F.col("_toxicity") < TOXIC_FROM).drop("_toxicity")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links at Jaccard similarity 0.8."""
    return keep_representatives(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken, with `epoch` and `words`."""
    return mixed_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: The stages learn from labels and redact by code points: DuckDB has no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
