"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.catalog.sources import raw_documents
from siftspark.functions import after_dot, experiment_of_file, leaf_kind, right_strip
from siftspark.session import staged, work_path
from siftspark.sinks import write_raw
from siftspark.sources import read_raw_json


@query(
    """SELECT c_custkey, left(right('/raw/' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '.json', 9), 4)
        AS code,
      lower(c_name) AS low, upper(c_mktsegment) AS up, c_name AS stripped,
      split_part('_customer.' || lower(c_mktsegment), '.', 2) AS attribute,
      'https://host/' || lower(c_name) || '.cif.gz' AS link
    FROM customer"""
)
def string_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(
        F.lit("/raw/"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.lit(".json")
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        experiment_of_file(path).alias("code"),
        F.lower("c_name").alias("low"),
        F.upper("c_mktsegment").alias("up"),
        right_strip(F.concat("c_name", F.lit(" \t\r\n"))).alias("stripped"),
        after_dot(F.concat(F.lit("_customer."), F.lower("c_mktsegment"))).alias("attribute"),
        F.concat(F.lit("https://host/"), F.lower("c_name"), F.lit(".cif.gz")).alias("link"),
    )


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to a variant, one leaf of it as a number."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.try_variant_get(F.parse_json("props"), "$.k", "int").alias("k")
    )


@query("SELECT event_id, '{\"type\":\"' || event_type || '\",\"user\":' || user_id || '}' AS body FROM events")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))
    return table(spark, sf_dir, "events").select("event_id", F.to_json(body).alias("body"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, a AS attribute,
      CASE a WHEN 'content' THEN 'list' ELSE 'str' END AS kind
    FROM documents, (VALUES ('lang'), ('source'), ('text'), ('content')) AS v(a)"""
)
def leaf_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each JSON leaf is."""
    path = work_path(spark, "raw")
    write_raw(raw_documents(spark, sf_dir), path)
    leaves = read_raw_json(spark, path).select(
        "experiment", F.explode("data").alias("category", "_attributes")
    )
    return leaves.select("experiment", F.explode("_attributes").alias("attribute", "_leaf")).select(
        "experiment", "attribute", leaf_kind(F.col("_leaf")).alias("kind")
    )


@query("SELECT n_nationkey, 'nation.parquet' AS file FROM nation")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        "n_nationkey", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    )


@query("SELECT o_orderkey, TRUE AS stamped, CAST(NULL AS TIMESTAMP) AS finished_ts FROM orders")
def ledger_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger entries, written and read again: added between the start and the end of this."""
    before = spark.sql("SELECT current_timestamp()").first()[0]
    ledger = staged(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.current_timestamp().alias("added_ts"),
            F.lit(None).cast("timestamp_ntz").alias("finished_ts"),
        ),
        "ledger",
    )
    stamped = F.col("added_ts").between(F.lit(before), F.current_timestamp())
    return ledger.select("o_orderkey", stamped.alias("stamped"), "finished_ts")
