"""Runs over a ledger: what is open is refined, what came through is closed by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.operators.keys import distinct_keys
from siftspark.plans.ingest import read_versions
from siftspark.plans.layout import Layout
from siftspark.plans.refine import refine
from siftspark.registry import LINEAGE, Registry
from siftspark.session import staged
from siftspark.sinks.buckets import merge_into, read_table
from siftspark.sources.control import finish_inputs, pending_inputs

KEYS = [LINEAGE, "added_ts"]
SCHEMA = T.StructType(
    [
        T.StructField(LINEAGE, T.StringType(), False),
        T.StructField("added_ts", T.TimestampType(), False),
        T.StructField("finished_ts", T.TimestampType()),
    ]
)


def read_ledger(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout.ledger, SCHEMA, layout.buckets)


def queue_inputs(ids: DataFrame, layout: Layout) -> None:
    """Open an entry for each listed experiment that has none open; ids are taken in upper case."""
    spark = ids.sparkSession
    wanted = distinct_keys(ids.select(F.upper(LINEAGE).alias(LINEAGE)).filter(F.col(LINEAGE).isNotNull()))
    waiting = pending_inputs(read_ledger(spark, layout)).select(LINEAGE)
    fresh = wanted.join(distinct_keys(waiting), LINEAGE, "left_anti")
    entries = fresh.select(
        LINEAGE, F.current_timestamp().alias("added_ts"), F.lit(None).cast("timestamp").alias("finished_ts")
    )
    # Written down first: the time must be the same wherever the rows are read.
    merge_into(spark, layout.ledger, SCHEMA, staged(entries, "ledger-entries"), KEYS, n=layout.buckets)


def refine_pending(
    texts: DataFrame, layout: Layout, registry: Registry, run: str, **options
) -> DataFrame:
    """Refine the experiments with open entries, then stamp `finished_ts` where all is held.

    An entry is closed if the version that the texts offer is the one held after the run, so it stays
    open if the run breaks, if the experiment is set aside, or if no text of it is offered. Entries that
    others add meanwhile are left as they are. Returns the run's plan; `options` are those of `refine`.
    """
    spark = texts.sparkSession
    waiting = staged(pending_inputs(read_ledger(spark, layout)), "open-inputs")
    plan = refine(waiting.select(LINEAGE), texts, layout, registry, run, **options)
    offered = texts.select(F.upper(LINEAGE).alias(LINEAGE), "etag")
    done = offered.join(read_versions(spark, layout), [LINEAGE, "etag"], "left_semi").select(LINEAGE)
    closed = finish_inputs(waiting, done, F.current_timestamp()).filter(F.col("finished_ts").isNotNull())
    merge_into(spark, layout.ledger, SCHEMA, staged(closed, "closed-inputs"), KEYS, n=layout.buckets)
    return plan
