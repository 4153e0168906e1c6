"""Bronze to typed silver rows and rejected rows with reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators.constraints import assert_unique, pk_violations
from siftspark.operators.keys import distinct_keys
from siftspark.operators.quality import ACCEPTED, split
from siftspark.operators.scope import in_scope
from siftspark.plans.ingest import last_run
from siftspark.plans.layout import Layout
from siftspark.plans.quarantine import set_aside
from siftspark.registry import LINEAGE, Registry
from siftspark.session import discard, work_path
from siftspark.sinks.buckets import merge_into, read_table, replace_experiments


def build_silver(
    spark: SparkSession,
    layout: Layout,
    registry: Registry,
    category: str,
    scope: DataFrame,
    scope_sync: bool = False,
    run: str | None = None,
    on_clash: str = "set aside",
) -> None:
    """Merge the run's accepted rows into silver and its other rows into rejected.

    Bronze is read once, in the scope's buckets only: both sides are staged together, which also
    cuts the lineage of the merges. Keys must be unique among accepted rows. An experiment in which
    they are not is set aside with the keys, and the others are merged; with `on_clash` "raise"
    nothing is written.
    By default rows that vanished, or changed sides, stay where they were merged before;
    with `scope_sync` the run's experiments are replaced on both sides.
    """
    spec = registry[category]
    if on_clash not in ("set aside", "raise"):
        raise ValueError(f"on_clash is 'set aside' or 'raise', not {on_clash!r}")
    listed = scope.filter(F.col("category") == category).select(LINEAGE)
    bronze = read_table(
        spark, layout.bronze(category), spec.bronze_schema(), layout.buckets, of=listed
    )
    sides = split(in_scope(bronze, scope, category), spec)
    staged_at = work_path(spark, f"split-{category}")
    sides.write.partitionBy(ACCEPTED).parquet(staged_at)
    staged = spark.read.schema(sides.schema).parquet(staged_at)
    good = staged.filter(F.col(ACCEPTED)).select("silver.*")
    bad = staged.filter(~F.col(ACCEPTED)).select("rejected.*")
    unique = good if spec.distinct else good.distinct()
    if on_clash == "raise":
        assert_unique(unique, spec.keys)
    else:
        clashes = pk_violations(unique, spec.keys).select(
            LINEAGE, F.to_json(F.struct(*spec.keys)).alias("_key")
        )
        set_aside(
            clashes,
            layout,
            run or last_run(spark, layout.landing()) or "unnamed",
            f"silver-{category}",
            F.lit("duplicate key"),
            F.col("_key"),
            category,
        )
        clashing = distinct_keys(clashes.select(LINEAGE))
        good, bad, listed = (df.join(clashing, LINEAGE, "left_anti") for df in (good, bad, listed))

    tables = (
        (layout.silver(category), spec.silver_schema(), good, False),
        (layout.rejected(category), spec.rejected_schema(), bad, True),
    )
    for path, schema, rows, null_safe in tables:
        if scope_sync:
            replace_experiments(spark, path, schema, rows, listed, n=layout.buckets)
        else:
            # Both contracts were checked above: the rules by the split, the keys by `clashes`.
            merge_into(spark, path, schema, rows, spec.keys, null_safe, layout.buckets, checked=True)
    discard(spark, staged_at)


def audit(
    spark: SparkSession,
    layout: Layout,
    registry: Registry,
    category: str,
    scope: DataFrame,
    side: str = "silver",
    n: int = 100,
) -> DataFrame:
    """The first n rows by key that a run's experiments have on one side."""
    spec = registry[category]
    path, schema = {
        "silver": (layout.silver(category), spec.silver_schema()),
        "rejected": (layout.rejected(category), spec.rejected_schema()),
    }[side]
    listed = scope.filter(F.col("category") == category).select(LINEAGE)
    rows = read_table(spark, path, schema, layout.buckets, of=listed)
    return in_scope(rows, scope, category).orderBy(*spec.keys).limit(n)
