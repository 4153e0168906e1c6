"""Scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.operators import arrays_to_rows
from siftspark.registry import Registry, category
from siftspark.session import work_path
from siftspark.sinks import (
    create_json_table,
    drop_table,
    write_category_documents,
    write_raw,
    write_text_files,
    write_texts,
)
from siftspark.sources import (
    category_documents,
    dictionary_links,
    inline_rows,
    json_path,
    page_links,
    even_chunks,
    parse_mmcif,
    parse_mmcif_chunks,
    register_mmcif,
    pending_inputs,
    raw_versions,
    read_category,
    read_id_list,
)


@query("SELECT c_name AS experiment FROM customer")
def id_list_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "ids")
    customer = table(spark, sf_dir, "customer")
    customer.select(F.concat("c_name", F.lit(" \t "))).write.text(path)
    return read_id_list(spark, path)


@query("SELECT c_name AS experiment FROM customer ORDER BY c_custkey LIMIT 100")
def id_list_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "ids")
    customer = table(spark, sf_dir, "customer")
    customer.orderBy("c_custkey").select(F.concat("c_name", F.lit("  "))).write.text(path)
    return read_id_list(spark, path, 100)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS experiment, o_orderdate AS added_ts
    FROM orders WHERE o_orderstatus <> 'F'"""
)
def pending_inputs_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("experiment"),
        F.col("o_orderdate").alias("added_ts"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("finished_ts"),
    )
    return pending_inputs(ledger).select("experiment", "added_ts")


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as mmCIF: key-value items, the whole text in a text field, and a loop
    with the length of each line."""
    # A line that starts with ';' would end the text field: shift it by one space.
    safe = F.replace("text", F.lit("\n;"), F.lit("\n ;"))
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.concat(i, F.lit(" "), F.length(line)))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment"),
        F.md5("text").alias("etag"),
        F.concat(
            *[F.lit("data_"), "doc_id"],
            *[F.lit("\n#\n_document.lang   "), "lang", F.lit("\n_document.source '"), "source"],
            *[F.lit("'\n_document.n_chars "), "n_chars", F.lit("\n_document.missing ?")],
            *[F.lit("\n_document.text\n;"), safe, F.lit("\n;\n#\n")],
            *[F.lit("loop_\n_line.no\n_line.n_chars\n"), F.array_join(lines, "\n")],
            F.lit("\n#\n_unregistered.item 1\n"),
        ).alias("text"),
    )


DOCUMENTS = Registry(
    {
        "document": category(
            "document",
            ["experiment", "lang", "source", "n_chars", "missing", "text"],
            types={"n_chars": "int"},
            required=["experiment", "lang", "text"],
            keys=["experiment"],
        ),
        "line": category(
            "line",
            ["experiment", "no", "n_chars"],
            types={"no": "int", "n_chars": "int"},
            required=["experiment", "no"],
            keys=["experiment", "no"],
        ),
    }
)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, source,
      CAST(n_chars AS VARCHAR) AS n_chars, '?' AS missing,
      replace(text, chr(10) || ';', chr(10) || ' ;') AS text
    FROM documents"""
)
def mmcif_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are landed as a table, then parsed; the key-value category as one row each."""
    path = work_path(spark, "texts")
    write_texts(document_texts(spark, sf_dir), path)
    raw = parse_mmcif(spark.read.parquet(path))
    documents = category_documents(raw, DOCUMENTS).filter(F.col("category") == "document")
    return arrays_to_rows(documents, DOCUMENTS["document"].attributes, ["experiment"])


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS VARCHAR) AS no,
      CAST(length(string_split(text, chr(10))[i]) AS VARCHAR) AS n_chars
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""
)
def mmcif_loop_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = parse_mmcif(document_texts(spark, sf_dir))
    lines = category_documents(raw, DOCUMENTS).filter(F.col("category") == "line")
    return arrays_to_rows(lines, DOCUMENTS["line"].attributes, ["experiment"])


_LINES = """SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS VARCHAR) AS no,
      CAST(length(string_split(text, chr(10))[i]) AS VARCHAR) AS n_chars
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""


def _line_rows(chunks: DataFrame) -> DataFrame:
    lines = even_chunks(chunks.filter(F.col("category") == "line"))
    return arrays_to_rows(lines, DOCUMENTS["line"].attributes, ["experiment"])


@query(_LINES)
def mmcif_chunk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loop of every text in chunks of 1000 rows, however long it is."""
    texts = document_texts(spark, sf_dir).select("experiment", "text")
    return _line_rows(parse_mmcif_chunks(texts, rows=1000, categories=["line"]))


def _mmcif_files(spark: SparkSession, sf_dir: str, gzip: bool = False) -> DataFrame:
    """Every document as an mmCIF file of its own, and the files as a data source."""
    path = work_path(spark, "mmcif-files")
    write_text_files(document_texts(spark, sf_dir), path, gzip=gzip)
    register_mmcif(spark)
    return spark.read.format("mmcif").options(pattern="part-*", namedBy="block", rows="1000").load(path)


@query(_LINES)
def mmcif_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_rows(_mmcif_files(spark, sf_dir))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, source, '?' AS missing,
      replace(text, chr(10) || ';', chr(10) || ' ;') AS text
    FROM documents"""
)
def mmcif_gzip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single values of gzipped files; a text field runs over many lines."""
    files = _mmcif_files(spark, sf_dir, gzip=True)
    documents = files.filter(F.col("category") == "document")
    return arrays_to_rows(documents, ["lang", "source", "missing", "text"], ["experiment"])


@query("SELECT CAST(doc_id AS VARCHAR) AS experiment, md5(text) AS etag, text FROM documents")
def text_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "texts")
    write_texts(
        table(spark, sf_dir, "documents").select(
            F.col("doc_id").cast("string").alias("experiment"), F.md5("text").alias("etag"), "text"
        ),
        path,
    )
    return spark.read.parquet(path)


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw JSON trees with scalar leaves and one array leaf."""
    tree = F.struct(
        F.struct("lang", "source", "text").alias("_document"),
        F.struct(F.split("text", "\n").alias("content")).alias("_line"),
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment"),
        tree.alias("data"),
        F.md5("text").alias("etag"),
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS experiment, md5(text) AS etag FROM documents")
def versioned_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "raw")
    write_raw(raw_documents(spark, sf_dir), path)
    return raw_versions(spark, path)


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def json_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "json")
    customer = table(spark, sf_dir, "customer")
    customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.json(path)
    return json_path(spark, path).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def external_json_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = work_path(spark, "json"), f"siftspark_json_{uuid.uuid4().hex}"
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    supplier.write.json(path)
    rows = create_json_table(spark, name, path, supplier.schema)
    drop_table(spark, name)  # external: the files, and the plan over them, remain
    return rows


@query("SELECT c_name AS value FROM customer")
def gzip_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "gz")
    table(spark, sf_dir, "customer").select("c_name").write.text(path, compression="gzip")
    return spark.read.text(path)


@query(
    """SELECT CAST(d.doc_id AS VARCHAR) AS experiment, md5(d.text) AS digest
    FROM documents d
    WHERE d.lang = 'en' AND d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"""
)
def category_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category (here the language) of the landed documents, for a run's experiments."""
    path = work_path(spark, "landing")
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment"),
        F.col("lang").alias("category"),
        F.create_map(F.lit("digest"), F.array(F.md5("text"))).alias("attributes"),
    )
    write_category_documents(documents, path)
    scope = (
        table(spark, sf_dir, "labels")
        .filter(F.col("quality") == 1)
        .select(F.lit("en").alias("category"), F.col("doc_id").cast("string").alias("experiment"))
    )
    return arrays_to_rows(read_category(spark, path, "en", scope), ["digest"], ["experiment"])


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""
)
def table_scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderstatus", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(100)
    )


@query(
    """SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link
    FROM pages"""
)
def html_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"))


@query(
    """SELECT page_id, CAST(i - 1 AS INTEGER) AS ordinal, links[i] AS link, items[i] AS item,
      split_part(items[i], '.', 2) AS attribute
    FROM (SELECT page_id, links, items, unnest(range(1, len(links) + 1)) AS i
          FROM (SELECT page_id,
                  regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1) AS links,
                  regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) AS items
                FROM pages))"""
)
def dictionary_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return dictionary_links(pages, list_class=None, item_class=None)


@query(
    """SELECT e.event_type, d.label, count(*) AS n
    FROM events e JOIN (VALUES ('click', 'polymer'), ('view', 'water'), ('error', NULL))
      AS d(event_type, label) ON e.event_type = d.event_type
    GROUP BY e.event_type, d.label"""
)
def inline_row_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inline_rows(
        spark,
        [("click", "polymer"), ("view", "water"), ("error", None)],
        "event_type string, label string",
    )
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(labels, "event_type").select("event_type", "label", "n")
