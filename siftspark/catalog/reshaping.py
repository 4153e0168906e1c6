"""Projections and changes of shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.catalog.sources import raw_documents
from siftspark.functions import strip_prefix
from siftspark.operators import (
    arrays_to_rows,
    collect_columns,
    conform,
    enrich_documents,
    enrich_eav,
    expand_requirements,
    explode_indexed,
    max_array_len,
    null_tokens,
    prune_to_schema,
    ragged,
    row_numbers,
    transpose_broadcast,
    typed,
    union_all,
)
from siftspark.registry import Registry, category
from siftspark.session import work_path
from siftspark.sinks import write_raw
from siftspark.sources import inline_rows, raw_eav, read_raw_json


@query(
    """SELECT c_custkey, NULLIF(CASE WHEN c_mktsegment = 'MACHINERY' THEN '?' ELSE c_mktsegment END, '?')
      AS segment, CASE WHEN c_mktsegment = 'BUILDING' THEN '.' ELSE c_name || '?' END AS name
    FROM customer"""
)
def null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only a cell that is the token becomes NULL; '.' and '...?' stay."""
    cells = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN '?' ELSE c_mktsegment END AS segment",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN '.' ELSE concat(c_name, '?') END AS name",
    )
    return null_tokens(cells)


@query(
    """SELECT 'S1' AS experiment, CAST(s_suppkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS details,
      s_name AS name, CAST(NULL AS VARCHAR) AS type FROM supplier"""
)
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_name AS name", "s_suppkey AS id")
    return conform(supplier, ["experiment", "id", "details", "name", "type"], experiment="S1")


@query("SELECT page_id, substr('_' || url, 2) AS once, url AS none, '_' || url AS twice FROM pages")
def strip_prefix_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        strip_prefix(F.concat(F.lit("_"), url)).alias("once"),
        strip_prefix(url).alias("none"),
        strip_prefix(F.concat(F.lit("__"), url)).alias("twice"),
    )


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, a AS attribute,
      CASE a WHEN 'lang' THEN lang WHEN 'source' THEN source ELSE text END AS value
    FROM documents, (VALUES ('lang'), ('source'), ('text')) AS v(a)
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), 'content', unnest(string_split(text, chr(10))) FROM documents"""
)
def scalar_to_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON leaves, scalar or array, as arrays; then one row per value."""
    path = work_path(spark, "raw")
    write_raw(raw_documents(spark, sf_dir), path)
    eav = raw_eav(read_raw_json(spark, path, ["document", "line"]))
    return eav.select("experiment", "attribute", F.explode("values").alias("value"))


def _line_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines and their lengths as parallel arrays."""
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        lines.alias("content"),
        F.transform(lines, lambda line: F.length(line).cast("string")).alias("n_chars"),
    )


_LINES = """
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, string_split(text, chr(10))[i] AS content,
      CAST(length(string_split(text, chr(10))[i]) AS VARCHAR) AS n_chars
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""


@query(f"SELECT doc_id, content, n_chars, CAST(NULL AS VARCHAR) AS absent FROM ({_LINES})")
def arrays_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _line_arrays(spark, sf_dir).select(
        "doc_id",
        F.create_map(
            F.lit("content"), F.col("content"), F.lit("n_chars"), F.col("n_chars")
        ).alias("attributes"),
    )
    return arrays_to_rows(documents, ["content", "n_chars", "absent"], ["doc_id"])


@query(_LINES)
def explode_with_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_indexed(_line_arrays(spark, sf_dir), ["content", "n_chars"], ["doc_id"], "pos")


@query(
    """SELECT doc_id, len(string_split(text, chr(10))) <> len(string_split(text, ' ')) AS is_ragged
    FROM documents"""
)
def ragged_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and words as columns of one table: even only where there are as many of each."""
    attributes = F.create_map(
        F.lit("lines"), F.split("text", "\n"), F.lit("words"), F.split("text", " ")
    )
    return table(spark, sf_dir, "documents").select("doc_id", ragged(attributes).alias("is_ragged"))


@query(
    """SELECT greatest(max(len(string_split(text, chr(10)))), max(len(string_split(text, ' '))))
      AS max_len FROM documents"""
)
def longest_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = table(spark, sf_dir, "documents").select(
        F.split("text", "\n").alias("lines"), F.split("text", " ").alias("words")
    )
    return max_array_len(arrays, ["lines", "words"]).select(F.col("max_len").cast("bigint"))


@query(
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS line, CAST(embedding[i] AS DOUBLE) AS x,
      CAST(embedding[1] AS DOUBLE) AS head
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""
)
def broadcast_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full vector by index, a one-element array repeated beside it, one column dropped."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.create_map(
            *[F.lit("x"), x],
            *[F.lit("head"), F.slice(x, 1, 1)],
            *[F.lit("dropped"), F.slice(x, 1, 2)],
        ).alias("attributes"),
    )
    return transpose_broadcast(vectors, ["x", "head", "dropped"], ["vec_id"], drop=["dropped"])


@query(
    """SELECT conv_id, CAST(floor(turn / 4) AS BIGINT) AS chunk,
      string_agg(role, '|' ORDER BY turn) AS role,
      string_agg(md5(text), '|' ORDER BY turn) AS text
    FROM conversations GROUP BY conv_id, floor(turn / 4)"""
)
def column_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns to lists in bounded chunks, however long a conversation is."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.md5("text"))
    lists = collect_columns(turns, ["conv_id"], "turn", ["role", "text"], chunk_rows=4)
    return lists.select(
        "conv_id",
        "chunk",
        F.array_join("role", "|").alias("role"),
        F.array_join("text", "|").alias("text"),
    )


EVENT = Registry(
    {
        "click": category("click", ["experiment", "value", "props"]),
        "view": category("view", ["experiment", "value", "user"]),
    }
)

_EAV = """
    SELECT CAST(event_id AS VARCHAR) AS experiment, event_type AS category, a AS attribute,
      CASE a WHEN 'props' THEN props WHEN 'user' THEN CAST(user_id AS VARCHAR) ELSE event_type END
        AS value
    FROM events, (VALUES ('props'), ('user'), ('kind')) AS v(a)"""

_KNOWN = "(VALUES ('click', 'value'), ('click', 'props'), ('view', 'value'), ('view', 'user'))"


def _event_eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(
        F.struct(F.lit("props").alias("attribute"), F.array("props").alias("values")),
        F.struct(
            F.lit("user").alias("attribute"),
            F.array(F.col("user_id").cast("string")).alias("values"),
        ),
        F.struct(F.lit("kind").alias("attribute"), F.array("event_type").alias("values")),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("experiment"),
        F.col("event_type").alias("category"),
        F.inline(pairs),
    )


@query(
    f"""SELECT e.experiment, e.category, e.attribute, e.value FROM ({_EAV}) e
    JOIN {_KNOWN} AS k(category, attribute)
      ON e.category = k.category AND e.attribute = k.attribute"""
)
def schema_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_to_schema(_event_eav(spark, sf_dir), EVENT).select(
        "experiment", "category", "attribute", F.get("values", F.lit(0)).alias("value")
    )


@query(
    f"""SELECT x.experiment, k.category, k.attribute, e.value
    FROM (SELECT DISTINCT experiment FROM ({_EAV})) x
    CROSS JOIN {_KNOWN} AS k(category, attribute)
    LEFT JOIN ({_EAV}) e ON e.experiment = x.experiment AND e.category = k.category
      AND e.attribute = k.attribute"""
)
def schema_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every registered attribute for every event, empty where the event has none."""
    return enrich_eav(_event_eav(spark, sf_dir), EVENT).select(
        "experiment", "category", "attribute", F.get("values", F.lit(0)).alias("value")
    )


@query(
    f"""SELECT CAST(v.event_id AS VARCHAR) AS experiment, k.category, k.attribute,
      CASE WHEN v.event_type = k.category THEN
        CASE k.attribute WHEN 'props' THEN v.props WHEN 'user' THEN CAST(v.user_id AS VARCHAR) END
      END AS value
    FROM events v CROSS JOIN {_KNOWN} AS k(category, attribute)"""
)
def document_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on documents: no join, no shuffle."""
    data = F.create_map(
        "event_type",
        F.create_map(
            *[F.lit("props"), F.array("props")],
            *[F.lit("user"), F.array(F.col("user_id").cast("string"))],
        ),
    )
    full = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("experiment"),
        F.explode(enrich_documents(data, EVENT)).alias("category", "_attributes"),
    )
    return full.select("experiment", "category", F.explode("_attributes").alias("attribute", "v")).select(
        "experiment", "category", "attribute", F.get("v", F.lit(0)).alias("value")
    )


@query(
    """SELECT l_orderkey, l_linenumber, TRY_CAST(quantity AS DOUBLE) AS quantity,
      TRY_CAST(number AS INTEGER) AS number, TRY_CAST(shipped AS DATE) AS shipped
    FROM (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'R' THEN 'abc' ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
        CASE WHEN l_returnflag = 'A' THEN '' ELSE ' ' || CAST(l_linenumber AS VARCHAR) || ' ' END AS number,
        CASE WHEN l_linestatus = 'O' THEN '2020-02-30'
          ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS shipped
      FROM lineitem)"""
)
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = category(
        "line",
        ["l_orderkey", "l_linenumber", "quantity", "number", "shipped"],
        types={
            "l_orderkey": "bigint",
            "l_linenumber": "int",
            "quantity": "double",
            "number": "int",
            "shipped": "date",
        },
    )
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE WHEN l_returnflag = 'R' THEN 'abc' ELSE CAST(l_quantity AS STRING) END AS quantity",
        "CASE WHEN l_returnflag = 'A' THEN '' ELSE concat(' ', l_linenumber, ' ') END AS number",
        "CASE WHEN l_linestatus = 'O' THEN '2020-02-30' "
        "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS shipped",
    )
    return typed(lines, spec)


@query("SELECT n_nationkey AS experiment_id, n_name AS details, r_name AS type FROM nation JOIN region ON n_regionkey = r_regionkey")
def rename_and_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struct fields taken out under new names, a helper column left out."""
    region = table(spark, sf_dir, "region").select("r_regionkey", F.struct("r_name").alias("_region"))
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnsRenamed({"n_nationkey": "experiment_id", "n_name": "details"})
        .select("*", F.col("_region.r_name").alias("type"))
        .drop("_region", "n_regionkey", "r_regionkey")
    )


@query(
    """SELECT DISTINCT p_brand AS category, p_type AS attribute FROM part
    WHERE p_brand IN ('Brand#1', 'Brand#2')
    UNION SELECT 'Brand#3', 'named' UNION SELECT 'Brand#2', 'extra'"""
)
def requirement_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two brands with all their types, two attributes by name."""
    dictionary = (
        table(spark, sf_dir, "part")
        .selectExpr("p_brand AS category", "p_type AS attribute", "p_size AS ordinal")
        .groupBy("category", "attribute")
        .agg(F.min("ordinal").alias("ordinal"))
    )
    requirements = inline_rows(
        spark,
        [("Brand#1", "*"), ("Brand#2", "*"), ("Brand#2", "extra"), ("Brand#3", "named")],
        "category string, attribute string",
    )
    return expand_requirements(requirements, dictionary).select("category", "attribute")


@query(
    "SELECT DISTINCT l_returnflag, l_linestatus, l_discount, l_tax FROM lineitem"
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]
    return table(spark, sf_dir, "lineitem").select(*columns).distinct()


@query(
    """SELECT o_orderkey, o_orderstatus,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders"""
)
def row_number_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys, each a third of all rows, numbered by all tasks."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return row_numbers(orders, ["o_orderkey"], ["o_orderstatus"])


@query("SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events")
def row_number_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return row_numbers(events, ["ts", "event_id"]).select("event_id", "user_id", "rn")


@query(
    """SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        table(spark, sf_dir, "customer").selectExpr(
            "'customer' AS kind", "c_custkey AS key", "c_acctbal AS balance"
        ),
        table(spark, sf_dir, "supplier").selectExpr(
            "s_acctbal AS balance", "'supplier' AS kind", "s_suppkey AS key"
        ),
        table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS key", "p_retailprice AS balance", "'part' AS kind"
        ),
    )
