"""Sinks and table maintenance: each writes, then returns what is stored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.catalog.base import query, table
from siftspark.catalog.sources import raw_documents
from siftspark.operators import replace_by_key, transpose_broadcast
from siftspark.plans import write_registry
from siftspark.registry import Registry, category, registry_from_frame
from siftspark.session import work_path
from siftspark.sinks import (
    append_by_name,
    append_positional,
    append_rows,
    create_table,
    drop_table,
    read_table,
    replace_experiments,
    truncate,
    truncate_reload,
    write_category_documents,
    write_raw,
    write_table,
)
from siftspark.sources import raw_eav, read_raw_json


class scratch_table:
    """A catalog table over a fresh path; its entry is dropped afterwards, its files stay
    readable for the lazy result."""

    def __init__(self, spark: SparkSession, schema: T.StructType):
        self.spark, self.schema = spark, schema
        self.name, self.path = f"siftspark_{uuid.uuid4().hex}", work_path(spark, "table")

    def __enter__(self) -> scratch_table:
        create_table(self.spark, self.name, self.schema, self.path)
        return self

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def __exit__(self, *_) -> None:
        drop_table(self.spark, self.name)


ACCOUNT = T.StructType().add("key", "long").add("name", "string").add("balance", "double")


def _accounts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "c_acctbal")
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS balance", "s_suppkey AS key", "s_name AS name"
    )
    return customer, supplier


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, 'document' AS category, a AS attribute,
      CASE a WHEN 'lang' THEN lang WHEN 'source' THEN source ELSE text END AS value
    FROM documents, (VALUES ('lang'), ('source'), ('text')) AS v(a)
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'line', 'content', unnest(string_split(text, chr(10)))
    FROM documents"""
)
def raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "raw")
    write_raw(raw_documents(spark, sf_dir), path)
    return raw_eav(read_raw_json(spark, path)).select(
        "experiment", "category", "attribute", F.explode("values").alias("value")
    )


@query(
    """SELECT event_type AS category, CAST(event_id AS VARCHAR) AS experiment, props
    FROM events"""
)
def category_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "landing")
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("category"),
        F.col("event_id").cast("string").alias("experiment"),
        F.create_map(F.lit("props"), F.array("props")).alias("attributes"),
    )
    write_category_documents(events, path)
    return spark.read.parquet(path).select(
        "category", "experiment", F.get(F.col("attributes")["props"], F.lit(0)).alias("props")
    )


@query(
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""
)
def positional_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = _accounts(spark, sf_dir)
    with scratch_table(spark, ACCOUNT) as target:
        append_positional(customer, target.name)
        append_positional(supplier.select("key", "name", "balance"), target.name)
        return target.rows()


@query(
    """SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier
    UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer"""
)
def insert_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = _accounts(spark, sf_dir)
    with scratch_table(spark, ACCOUNT) as target:
        append_by_name(supplier, target.name)
        append_by_name(customer.selectExpr("c_acctbal AS balance", "c_custkey AS key"), target.name)
        return target.rows()


@query(
    """SELECT DISTINCT event_type AS category, CAST(user_id AS VARCHAR) AS experiment FROM events
    UNION ALL SELECT * FROM (VALUES ('click', 'first user'), ('none', 'nobody'))"""
)
def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal and computed rows side by side in a control table."""
    schema = T.StructType().add("category", "string").add("experiment", "string")
    scope = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("category"), F.col("user_id").cast("string").alias("experiment")
    )
    with scratch_table(spark, schema) as target:
        append_rows(
            spark, [("click", "first user"), ("none", "nobody")], target.name
        )
        append_positional(scope.distinct(), target.name)
        return target.rows()


@query("SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier")
def truncate_and_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = _accounts(spark, sf_dir)
    with scratch_table(spark, ACCOUNT) as target:
        append_positional(customer, target.name)
        truncate_reload(supplier, target.name)
        return target.rows()


PART = category(
    "part",
    ["experiment", "id", "size", "price"],
    types={"size": "int", "price": "float"},
    required=["experiment", "id"],
    keys=["experiment", "id"],
)


@query(
    """SELECT p_brand AS experiment, CAST(p_partkey AS VARCHAR) AS id, p_size AS size,
      CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price FROM part"""
)
def typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDL from a registry entry, then a load by name."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "CAST(p_retailprice AS FLOAT) AS price",
        "p_size AS size",
        "CAST(p_partkey AS STRING) AS id",
        "p_brand AS experiment",
    )
    with scratch_table(spark, PART.silver_schema()) as target:
        append_by_name(rows, target.name)
        return target.rows().withColumn("price", F.col("price").cast("double"))


_REPLACED = """
    SELECT o_custkey AS experiment, o_orderkey AS id, 'held' AS state FROM orders
    WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL
    SELECT o_custkey, o_orderkey, 'new' FROM orders
    WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
      AND o_orderstatus <> 'F'"""


def _replacement(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All orders are held; customers with a pending order get their open orders anew."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS experiment", "o_orderkey AS id", "o_orderstatus"
    )
    listed = orders.filter("o_orderstatus = 'P'").select("experiment").distinct()
    target = orders.select("experiment", "id", F.lit("held").alias("state"))
    source = orders.filter("o_orderstatus <> 'F'").join(listed, "experiment", "left_semi")
    return target, source.select("experiment", "id", F.lit("new").alias("state")), listed


@query(_REPLACED)
def replace_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source, listed = _replacement(spark, sf_dir)
    return replace_by_key(target, source, "experiment", listed)


@query(_REPLACED)
def replace_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stored table, rewriting the touched buckets only."""
    target, source, listed = _replacement(spark, sf_dir)
    path = work_path(spark, "replaced")
    write_table(target, path, 16)
    replace_experiments(spark, path, target.schema, source, listed, n=16)
    return read_table(spark, path, target.schema, 16)


@query(
    """SELECT p_brand AS category, p_type AS attribute, '/' || p_brand || '/' || p_type AS link
    FROM part GROUP BY p_brand, p_type"""
)
def registry_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and type stand for category and attribute; both registry files are written."""
    path = work_path(spark, "registry")
    attributes = (
        table(spark, sf_dir, "part")
        .selectExpr(
            "p_brand AS category", "p_type AS attribute", "concat('/', p_brand, '/', p_type) AS link"
        )
        .distinct()
    )
    write_registry(attributes, Registry({"part": PART}), path)
    return spark.read.json(f"{path}/full_schema_dict").select("category", "attribute", "link")


@query(
    """SELECT lang AS category, list(source ORDER BY source) AS attributes
    FROM (SELECT DISTINCT lang, source FROM documents) GROUP BY lang"""
)
def registry_carcass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The empty document: languages stand for categories, their sources for attributes."""
    path = work_path(spark, "registry")
    pairs = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("category"), F.col("source").alias("attribute")
    )
    attributes = pairs.distinct().withColumn("ordinal", F.lit(0)).withColumn("link", F.lit(""))
    write_registry(attributes, registry_from_frame(attributes), path)
    carcass = spark.read.schema("category string, attributes array<string>")
    return carcass.json(f"{path}/schema_carcass")


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer")
def truncate_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filled table is emptied, and then takes other rows."""
    customer, supplier = _accounts(spark, sf_dir)
    with scratch_table(spark, ACCOUNT) as target:
        append_positional(supplier.select("key", "name", "balance"), target.name)
        truncate(spark, target.name)
        append_positional(customer, target.name)
        return target.rows()


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS INTEGER) AS line,
      string_split(text, chr(10))[i] AS content, lang, source
    FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)"""
)
def dictionary_row_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transposed rows as JSON lines: one array of full length, two single values repeated."""
    path = work_path(spark, "rows")
    columns = F.create_map(
        *[F.lit("content"), F.split("text", "\n")],
        *[F.lit("lang"), F.array("lang")],
        *[F.lit("source"), F.array("source")],
    )
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment"), columns.alias("attributes")
    )
    rows = transpose_broadcast(documents, ["content", "lang", "source"], ["experiment"])
    rows.write.json(path)
    return spark.read.schema(rows.schema).json(path)
