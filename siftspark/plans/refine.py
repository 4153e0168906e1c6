"""A whole run: listed experiments to silver and rejected tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.keys import distinct_keys
from siftspark.operators.scope import broadcast_if_small
from siftspark.plans.bronze import build_bronze
from siftspark.plans.ingest import last_run, land_raw, plan_ingest, read_versions, record_versions
from siftspark.plans.layout import Layout
from siftspark.plans.quarantine import read_quarantine
from siftspark.plans.silver import build_silver
from siftspark.registry import LINEAGE, Registry
from siftspark.session import work_path


def refine(
    ids: DataFrame,
    texts: DataFrame,
    layout: Layout,
    registry: Registry,
    run: str,
    changed_only: bool = True,
    scope_sync: bool = False,
    on_clash: str = "set aside",
) -> DataFrame:
    """Refine the listed experiments whose text (experiment, etag, text) is new or changed.

    Runs are named so that later ones sort after earlier ones, which is checked; a run may be
    repeated under its name. Returns the run's plan (experiment, etag, status). Versions are
    noted last, so a run that broke is taken up again by the next one, and not at all for
    experiments that were set aside, so the next run tries them again.
    """
    spark = texts.sparkSession
    before = last_run(spark, layout.versions())
    if before is not None and run < before:
        raise ValueError(f"run {run!r} must sort after {before!r}")
    plan = plan_ingest(
        ids, texts.select(LINEAGE, "etag"), read_versions(spark, layout), changed_only
    )
    # The plan depends on versions this run will add to, so it is written down first.
    plan_at = work_path(spark, "plan")
    plan.write.parquet(plan_at)
    plan = spark.read.schema(plan.schema).parquet(plan_at)
    if plan.isEmpty():
        return plan
    # Texts are the bulk of the archive: do not shuffle them if the plan can be broadcast.
    wanted = broadcast_if_small(plan.select(LINEAGE))
    todo = texts.withColumn(LINEAGE, F.upper(LINEAGE)).join(wanted, LINEAGE, "left_semi")
    scope = land_raw(todo, layout, registry, run)
    held = {row["category"] for row in scope.select("category").distinct().collect()}
    for name in registry.names:
        if name in held:
            build_bronze(spark, layout, registry, name, scope, run)
            build_silver(spark, layout, registry, name, scope, scope_sync, run, on_clash)
    aside = distinct_keys(read_quarantine(spark, layout, run).select(LINEAGE))
    record_versions(plan.join(aside, LINEAGE, "left_anti"), layout, run)
    return plan
