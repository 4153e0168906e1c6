"""From a list of experiments to landed documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators.constraints import assert_unique
from siftspark.operators.scope import build_scope, in_scope, latest_versions, version_status
from siftspark.plans.layout import Layout
from siftspark.plans.quarantine import set_aside
from siftspark.registry import LINEAGE, Registry
from siftspark.sinks.documents import write_category_documents, write_raw
from siftspark.sources.documents import LANDING, category_documents, read_category, read_raw_json
from siftspark.sources.mmcif import parse_mmcif, text_problem


def plan_ingest(
    ids: DataFrame, manifest: DataFrame, present: DataFrame, changed_only: bool = True
) -> DataFrame:
    """Listed experiments that the manifest offers: (experiment, etag, status).

    Ids are compared in upper case. Unchanged ones are left out unless asked for.
    """
    wanted = ids.select(F.upper(LINEAGE).alias(LINEAGE))
    offered = manifest.select(F.upper(LINEAGE).alias(LINEAGE), "etag")
    plan = version_status(in_scope(offered, wanted), latest_versions(present))
    return plan.filter(F.col("status") != "unchanged") if changed_only else plan


def land_raw(texts: DataFrame, layout: Layout, registry: Registry, run: str) -> DataFrame:
    """Parse texts (experiment, etag, text), land the documents, return the run's scope.

    Writes the raw documents of the run, then, read back from there with only registered
    categories declared, one document per category, then the run's scope. Texts that are
    empty or cut off are set aside. Every step overwrites its own run's output, so a broken
    run is repeated as it is, and what other runs landed stays.
    """
    spark = texts.sparkSession
    texts = texts.withColumn(LINEAGE, F.upper(LINEAGE))
    assert_unique(texts.select(LINEAGE), [LINEAGE])
    problem = text_problem(F.col("text"))
    set_aside(texts.filter(problem.isNotNull()), layout, run, "texts", problem, F.col("text"))
    raw = parse_mmcif(texts.filter(problem.isNull()), as_json=True)
    write_raw(raw, layout.raw(run), mode="overwrite")
    landed = read_raw_json(spark, layout.raw(run), registry.names)
    write_category_documents(category_documents(landed, registry), layout.landing(run))
    landing = spark.read.schema(LANDING).parquet(layout.landing(run))
    build_scope(landing).write.mode("overwrite").parquet(layout.scope)
    return read_scope(spark, layout)


def last_run(spark: SparkSession, path: str) -> str | None:
    """The run that sorts last among those below a path; only partition names are read."""
    try:
        return spark.read.schema("run string").parquet(path).agg(F.max("run")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_landed(
    spark: SparkSession,
    layout: Layout,
    category: str,
    scope: DataFrame | None = None,
    run: str | None = None,
) -> DataFrame:
    """Documents of one category as a run landed them, or of each experiment's last run."""
    if run is not None:
        return read_category(spark, layout.landing(run), category, scope)
    landed = spark.read.schema(f"{LANDING}, run string").parquet(layout.landing())
    landed = landed.filter(F.col("category") == category)
    if scope is not None:
        landed = in_scope(landed, scope, category)
    last = landed.groupBy(LINEAGE).agg(F.max("run").alias("run"))
    return landed.join(last, [LINEAGE, "run"], "left_semi").select(LINEAGE, "attributes", "n_rows")


def read_scope(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema("category string, experiment string").parquet(layout.scope)


def record_versions(versions: DataFrame, layout: Layout, run: str) -> None:
    """Note (experiment, etag) as held, once the run's tables are written."""
    versions.select(LINEAGE, "etag").write.mode("overwrite").parquet(layout.versions(run))


def read_versions(spark: SparkSession, layout: Layout) -> DataFrame:
    """Held version of each experiment: that of its last run."""
    try:
        noted = spark.read.schema("experiment string, etag string, run string").parquet(
            layout.versions()
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "experiment string, etag string")
    return latest_versions(noted, order="run")
