"""Landed documents of one category to its all-string bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators.constraints import require_rows
from siftspark.operators.keys import distinct_keys
from siftspark.operators.reshape import arrays_to_rows, conform, null_tokens, ragged
from siftspark.plans.ingest import last_run, read_landed
from siftspark.plans.layout import Layout
from siftspark.plans.quarantine import set_aside
from siftspark.registry import LINEAGE, Category, Registry
from siftspark.session import staged
from siftspark.sinks.buckets import replace_experiments
from siftspark.sources.mmcif import even_chunks


def bronze_rows(documents: DataFrame, category: Category) -> DataFrame:
    """Documents (experiment, attributes) of even length to bronze rows."""
    rows = arrays_to_rows(documents, category.attributes, [LINEAGE])
    return conform(null_tokens(rows), category.names)


def build_bronze(
    spark: SparkSession,
    layout: Layout,
    registry: Registry,
    category: str,
    scope: DataFrame,
    run: str | None = None,
) -> None:
    """Replace the scope's experiments in the bronze table, by documents of one run or the last ones.

    Documents whose attributes differ in length are set aside with the reason, and what the
    table holds of their experiments stays.
    """
    spec = registry[category]
    documents = read_landed(spark, layout, category, scope, run)
    require_rows(documents, f"no experiment of this run holds {category}")
    set_aside_uneven(documents, layout, spec, run or last_run(spark, layout.landing()))
    replace_documents(spark, layout, spec, documents)


def set_aside_uneven(documents: DataFrame, layout: Layout, spec: Category, run: str) -> None:
    """Keep documents whose attributes differ in length in the quarantine."""
    uneven = documents.filter(F.col("n_rows").isNull())
    document = F.to_json("attributes")
    set_aside(uneven, layout, run, f"bronze-{spec.name}", F.lit("ragged"), document, spec.name)


def replace_chunks(
    spark: SparkSession, layout: Layout, spec: Category, chunks: DataFrame, run: str
) -> None:
    """The same from chunks (experiment, category, first_row, attributes), as mmCIF files give them,
    so a document's table may be of any size.

    What the chunks say of an experiment replaces what the table holds of it. One with an uneven table is
    set aside by its name and the row its table breaks off at; what the table holds of it stays.
    """
    own = staged(chunks.filter(F.col("category") == spec.name), "chunks")
    uneven = own.filter(ragged(F.col("attributes")))
    broken_at = F.to_json(F.struct("first_row", F.array_max(F.transform(F.map_values("attributes"), F.size)).alias("rows")))
    set_aside(uneven, layout, run, f"bronze-{spec.name}", F.lit("ragged"), broken_at, spec.name)
    even = even_chunks(own)
    replace_experiments(
        spark,
        layout.bronze(spec.name),
        spec.bronze_schema(),
        bronze_rows(even, spec),
        listed=distinct_keys(even.select(LINEAGE)),
        filled=even.select(LINEAGE),
        n=layout.buckets,
    )


def replace_documents(
    spark: SparkSession, layout: Layout, spec: Category, documents: DataFrame
) -> None:
    """Replace the experiments of landed documents that form a table."""
    even = documents.filter(F.col("n_rows").isNotNull())
    replace_experiments(
        spark,
        layout.bronze(spec.name),
        spec.bronze_schema(),
        bronze_rows(even, spec),
        listed=even.select(LINEAGE),
        filled=even.filter(F.col("n_rows") > 0).select(LINEAGE),
        n=layout.buckets,
    )
