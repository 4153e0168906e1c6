"""Upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.operators import merge_upsert
from siftspark.session import work_path
from siftspark.sinks import merge_into, read_table, write_table

_ORDERS_MERGED = """
    WITH source AS (SELECT l_orderkey AS id, max(l_linenumber) AS last_line, count(*) AS n_lines
                    FROM lineitem GROUP BY l_orderkey),
    target AS (SELECT o_orderkey AS id, 0 AS last_line, CAST(0 AS BIGINT) AS n_lines
               FROM orders WHERE o_orderstatus <> 'O')
    SELECT COALESCE(s.id, t.id) AS id,
      CASE WHEN s.id IS NULL THEN t.last_line ELSE s.last_line END AS last_line,
      CASE WHEN s.id IS NULL THEN t.n_lines ELSE s.n_lines END AS n_lines
    FROM target t FULL JOIN source s ON t.id = s.id"""


def _order_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Closed orders are held without lines; the source has every order that has lines."""
    target = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus <> 'O'")
        .selectExpr("o_orderkey AS id", "0 AS last_line", "CAST(0 AS BIGINT) AS n_lines")
    )
    source = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.max("l_linenumber").alias("last_line"), F.count(F.lit(1)).alias("n_lines"))
    )
    return target, source


@query(_ORDERS_MERGED)
def merge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _order_lines(spark, sf_dir)
    return merge_upsert(target, source, ["id"])


@query(
    """WITH source AS (SELECT conv_id, turn, upper(role) AS role, length(text) AS n_chars
                       FROM conversations WHERE role <> 'user'),
    target AS (SELECT conv_id, turn, role, CAST(0 AS BIGINT) AS n_chars FROM conversations
               WHERE role <> 'system')
    SELECT COALESCE(s.conv_id, t.conv_id) AS conv_id, COALESCE(s.turn, t.turn) AS turn,
      CASE WHEN s.conv_id IS NULL THEN t.role ELSE s.role END AS role,
      CASE WHEN s.conv_id IS NULL THEN t.n_chars ELSE s.n_chars END AS n_chars
    FROM target t FULL JOIN source s ON t.conv_id = s.conv_id AND t.turn = s.turn"""
)
def merge_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    target = turns.filter("role <> 'system'").selectExpr(
        "conv_id", "turn", "role", "CAST(0 AS BIGINT) AS n_chars"
    )
    source = turns.filter("role <> 'user'").selectExpr(
        "conv_id", "turn", "upper(role) AS role", "CAST(length(text) AS BIGINT) AS n_chars"
    )
    return merge_upsert(target, source, ["conv_id", "turn"])


@query(
    """WITH source AS (SELECT CASE WHEN event_type <> 'error' THEN event_id END AS id,
                         user_id, 'new' AS state
                       FROM events WHERE event_type <> 'view'),
    target AS (SELECT CASE WHEN event_type <> 'error' THEN event_id END AS id,
                 user_id, 'held' AS state FROM events)
    SELECT id, user_id, state FROM source
    UNION ALL
    SELECT id, user_id, state FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM source s
      WHERE s.user_id = t.user_id AND s.id IS NOT DISTINCT FROM t.id)"""
)
def merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the rows have a NULL in their key; a user's are one group."""
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"),
        "user_id",
        "event_type",
    )
    target = events.select("id", "user_id", F.lit("held").alias("state"))
    source = events.filter("event_type <> 'view'").select("id", "user_id", F.lit("new").alias("state"))
    return merge_upsert(target, source, ["id", "user_id"], null_safe=True)


@query(
    "SELECT id AS experiment, last_line, n_lines FROM (" + _ORDERS_MERGED + ") AS merged"
)
def merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first merge in a stored table; the source is staged, as it is read more than once."""
    target, source = (
        df.withColumnRenamed("id", "experiment") for df in _order_lines(spark, sf_dir)
    )
    path, staged_at = work_path(spark, "merged"), work_path(spark, "source")
    write_table(target, path, 16)
    source.write.parquet(staged_at)
    merge_into(
        spark, path, target.schema, spark.read.parquet(staged_at), ["experiment"], n=16
    )
    return read_table(spark, path, target.schema, 16)
