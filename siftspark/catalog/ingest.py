"""Version checks and run scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.operators import build_scope, changed, in_scope, version_status
from siftspark.plans import plan_ingest

_MANIFEST = "SELECT CAST(doc_id AS VARCHAR) AS experiment, md5(text) AS etag FROM documents"
_PRESENT = """SELECT CAST(doc_id AS VARCHAR) AS experiment,
      CASE WHEN lang = 'de' THEN 'old' ELSE md5(text) END AS etag FROM documents WHERE lang <> 'fr'"""
_STATUS = f"""
    SELECT m.experiment, m.etag, CASE WHEN p.experiment IS NULL THEN 'new'
      WHEN p.etag = m.etag THEN 'unchanged' ELSE 'changed' END AS status
    FROM ({_MANIFEST}) m LEFT JOIN ({_PRESENT}) p ON p.experiment = m.experiment"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The digest of a text is its version; French texts are not held, German ones are stale."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment"), F.md5("text").alias("etag"), "lang"
    )
    held = documents.filter("lang <> 'fr'").select(
        "experiment", F.when(F.col("lang") == "de", "old").otherwise(F.col("etag")).alias("etag")
    )
    return documents.select("experiment", "etag"), held


@query(f"SELECT experiment, etag FROM ({_STATUS}) WHERE status <> 'unchanged'")
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed(*_versions(spark, sf_dir))


@query(_STATUS)
def version_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_status(*_versions(spark, sf_dir))


@query(
    f"""SELECT * FROM ({_STATUS}) WHERE status <> 'unchanged'
      AND experiment IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"""
)
def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are the ids asked for."""
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("experiment"))
    return plan_ingest(ids, *_versions(spark, sf_dir))


def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("experiment")
    )


@query(
    """SELECT l_orderkey AS experiment, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def scope_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS experiment", "l_linenumber", "l_quantity"
    )
    return in_scope(lines, _scope(spark, sf_dir), "1-URGENT")


@query(
    """SELECT l_orderkey AS experiment, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders)"""
)
def scope_semi_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS experiment", "l_linenumber", "l_quantity"
    )
    return in_scope(lines, _scope(spark, sf_dir))


@query("SELECT DISTINCT event_type AS category, user_id AS experiment FROM events")
def run_scope_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_scope(
        table(spark, sf_dir, "events").selectExpr("event_type AS category", "user_id AS experiment")
    )


@query(
    """SELECT user_id AS experiment, max(value) AS top FROM events
    WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY user_id"""
)
def run_category_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments that hold one category, used without listing them on the driver."""
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "experiment")
    scope = build_scope(events.withColumnRenamed("event_type", "category"))
    tops = events.groupBy("experiment").agg(F.max("value").alias("top"))
    return in_scope(tops, scope, "purchase")
