"""Whole runs over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.catalog.sources import DOCUMENTS, document_texts
from siftspark.plans import (
    Layout,
    audit,
    build_bronze,
    build_registry,
    build_silver,
    explode_category,
    land_raw,
    queue_inputs,
    read_landed,
    read_ledger,
    read_quarantine,
    read_versions,
    refine,
    refine_pending,
    replace_chunks,
)
from siftspark.registry import Registry, category, default_registry
from siftspark.session import work_path
from siftspark.sinks import append_by_name, create_json_table, create_table, drop_table, read_table
from siftspark.sources import inline_rows, parse_mmcif_chunks

BUCKETS = 8


@query(
    """SELECT category, CAST(doc_id AS VARCHAR) AS experiment
    FROM documents, (VALUES ('document'), ('line')) AS v(category)"""
)
def landed_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to raw documents to category documents; the scope is what has landed."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    return land_raw(document_texts(spark, sf_dir), layout, DOCUMENTS, "run1")


def _landed(spark: SparkSession, sf_dir: str) -> tuple[Layout, DataFrame]:
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    return layout, land_raw(document_texts(spark, sf_dir), layout, DOCUMENTS, "run1")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, source,
      CAST(n_chars AS VARCHAR) AS n_chars, CAST(NULL AS VARCHAR) AS missing,
      replace(text, chr(10) || ';', chr(10) || ' ;') AS text
    FROM documents"""
)
def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, scope = _landed(spark, sf_dir)
    build_bronze(spark, layout, DOCUMENTS, "document", scope)
    schema = DOCUMENTS["document"].bronze_schema()
    return read_table(spark, layout.bronze("document"), schema, BUCKETS)


_LINES = """
    SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS INTEGER) AS no,
      CAST(length(string_split(text, chr(10))[i]) AS INTEGER) AS n_chars
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""


@query(_LINES)
def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, scope = _landed(spark, sf_dir)
    build_bronze(spark, layout, DOCUMENTS, "line", scope)
    build_silver(spark, layout, DOCUMENTS, "line", scope)
    return read_table(spark, layout.silver("line"), DOCUMENTS["line"].silver_schema(), BUCKETS)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS VARCHAR) AS no,
      CAST(length(string_split(text, chr(10))[i]) AS VARCHAR) AS n_chars
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""
)
def bronze_from_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of any size into bronze, in chunks of 100 rows; the second time changes nothing."""
    layout, line = Layout(work_path(spark, "archive"), BUCKETS), DOCUMENTS["line"]
    texts = document_texts(spark, sf_dir).select("experiment", "text")
    for run in ("run1", "run2"):
        replace_chunks(spark, layout, line, parse_mmcif_chunks(texts, rows=100, categories=["line"]), run)
    return read_table(spark, layout.bronze("line"), line.bronze_schema(), BUCKETS)


LABELLED = Registry(
    {
        "document": category(
            "document",
            ["experiment", "lang", "source"],
            required=["experiment"],
            keys=["experiment"],
            allowed={"lang": ["de", "en", "es"]},
        )
    }
)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, source FROM documents
    WHERE lang = 'fr' ORDER BY experiment LIMIT 100"""
)
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred rejected rows of a run."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    scope = land_raw(document_texts(spark, sf_dir), layout, LABELLED, "run1")
    build_bronze(spark, layout, LABELLED, "document", scope)
    build_silver(spark, layout, LABELLED, "document", scope)
    rows = audit(spark, layout, LABELLED, "document", scope, side="rejected", n=100)
    return rows.select("experiment", "lang", "source")


@query(
    """SELECT CAST(d.doc_id AS VARCHAR) AS experiment,
      md5(d.text) || CASE WHEN d.lang = 'de' THEN '-2' ELSE '' END AS etag,
      CASE WHEN d.lang = 'de' THEN 'second' ELSE d.source END AS source
    FROM documents d WHERE lang <> 'fr'"""
)
def refine_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over all texts, then one in which only the German ones have changed."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment"), "lang", "source", F.md5("text").alias("etag")
    )

    def texts(etag, source) -> DataFrame:
        return documents.select(
            "experiment",
            etag.alias("etag"),
            F.concat(
                *[F.lit("data_"), "experiment", F.lit("\n_document.lang "), "lang"],
                *[F.lit("\n_document.source "), source, F.lit("\n")],
            ).alias("text"),
        )

    german = F.col("lang") == "de"
    ids = documents.select("experiment")
    refine(ids, texts(F.col("etag"), F.col("source")), layout, LABELLED, "run1")
    etag = F.when(german, F.concat("etag", F.lit("-2"))).otherwise(F.col("etag"))
    # Unchanged texts are offered with another content, which must not be taken.
    source = F.when(german, "second").otherwise(F.lit("unread"))
    refine(ids, texts(etag, source), layout, LABELLED, "run2")
    silver = LABELLED["document"].silver_schema()
    return (
        read_table(spark, layout.silver("document"), silver, BUCKETS)
        .join(read_versions(spark, layout), "experiment")
        .select("experiment", "etag", "source")
    )


SOURCED = Registry(
    {
        "document": category(
            "document",
            ["experiment", "lang", "source"],
            required=["experiment"],
            keys=["experiment"],
        )
    }
)


def sourced_texts(documents: DataFrame, second=None, etag=None) -> DataFrame:
    """Each document's lang and source as a table of one row; where `second` is a column that is
    not NULL, its text follows as a second row, whole or cut."""
    head = F.lit("\nloop_\n_document.lang\n_document.source\n")
    more = F.lit("") if second is None else F.coalesce(F.concat(second, F.lit("\n")), F.lit(""))
    experiment = F.col("doc_id").cast("string")
    return documents.select(
        experiment.alias("experiment"),
        (F.md5("text") if etag is None else etag).alias("etag"),
        F.concat(
            *[F.lit("data_"), experiment, head, "lang", F.lit(" "), "source", F.lit("\n"), more]
        ).alias("text"),
    )


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, source,
      CASE WHEN lang = 'fr' THEN 'run2' ELSE 'run1' END AS run
    FROM documents"""
)
def refine_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """French texts are ragged in the first run and mended, under the same etag, in the second."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    documents = table(spark, sf_dir, "documents")
    ids = documents.select(F.col("doc_id").cast("string").alias("experiment"))
    ragged = F.when(F.col("lang") == "fr", F.col("lang"))
    refine(ids, sourced_texts(documents, ragged), layout, SOURCED, "run1")
    refine(ids, sourced_texts(documents), layout, SOURCED, "run2")
    versions = spark.read.schema("experiment string, run string").parquet(layout.versions())
    silver = SOURCED["document"].silver_schema()
    return read_table(spark, layout.silver("document"), silver, BUCKETS).join(versions, "experiment")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, COALESCE(lang <> 'fr', TRUE) AS finished
    FROM documents
    UNION ALL SELECT c_name AS experiment, FALSE AS finished FROM customer"""
)
def refine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of ragged (French) texts, and of customers, of whom there are no texts, stay open."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    documents = table(spark, sf_dir, "documents")
    ids = documents.select(F.col("doc_id").cast("string").alias("experiment"))
    queue_inputs(ids.unionByName(table(spark, sf_dir, "customer").select(F.col("c_name").alias("experiment"))), layout)
    ragged = F.when(F.col("lang") == "fr", F.col("lang"))
    refine_pending(sourced_texts(documents, ragged), layout, SOURCED, "run1")
    ledger = read_ledger(spark, layout)
    # Names of customers come in the upper case of the ledger.
    name = F.regexp_replace("experiment", "^CUSTOMER", "Customer").alias("experiment")
    return ledger.select(name, F.col("finished_ts").isNotNull().alias("finished"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang,
      CASE WHEN lang IN ('de', 'fr') THEN 'second' ELSE source END AS source
    FROM documents"""
)
def landing_of_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run lands French and, again, German documents; those of the first stay."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    documents = table(spark, sf_dir, "documents")
    land_raw(sourced_texts(documents.filter("lang <> 'fr'")), layout, SOURCED, "run1")
    again = documents.filter("lang IN ('de', 'fr')").withColumn("source", F.lit("second"))
    land_raw(sourced_texts(again), layout, SOURCED, "run2")
    landed = read_landed(spark, layout, "document")
    first = [F.get(F.col("attributes")[a], F.lit(0)).alias(a) for a in ("lang", "source")]
    return landed.select("experiment", *first)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, source, CAST(NULL AS VARCHAR) AS reason
    FROM documents WHERE lang <> 'de'
    UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL, 'duplicate key'
    FROM documents WHERE lang = 'de'"""
)
def silver_with_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German documents hold two rows of one key: they wait, all others are merged."""
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    documents = table(spark, sf_dir, "documents")
    ids = documents.select(F.col("doc_id").cast("string").alias("experiment"))
    clash = F.when(F.col("lang") == "de", F.lit("de other"))
    refine(ids, sourced_texts(documents, clash), layout, SOURCED, "run1")
    silver = SOURCED["document"].silver_schema()
    merged = read_table(spark, layout.silver("document"), silver, BUCKETS)
    waiting = read_quarantine(spark, layout, "run1").select("experiment", "reason")
    return merged.unionByName(waiting, allowMissingColumns=True)


@query(
    r"""WITH links AS (
      SELECT lang, CAST(i - 1 AS INTEGER) AS ordinal, items[i] AS attribute FROM (
        SELECT lang, items, unnest(range(1, len(items) + 1)) AS i FROM (
          SELECT regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
            list_transform(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2),
              lambda x: split_part(x, '.', 1)) AS items
          FROM pages))),
    listed AS (SELECT lang AS category, attribute, min(ordinal) AS ordinal FROM links
      WHERE lang IN ('de', 'fr') GROUP BY ALL),
    wanted AS (SELECT category, attribute, min(ordinal) AS ordinal FROM (
      SELECT * FROM listed
      UNION ALL SELECT 'en', 'named', 2147483647 UNION ALL SELECT 'de', 'extra', 2147483647)
      GROUP BY ALL)
    SELECT category, attribute,
      row_number() OVER (PARTITION BY category ORDER BY ordinal, attribute) AS ordinal
    FROM wanted"""
)
def registry_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link lists of the pages as dictionary pages of their languages."""
    item = r'<li class="list-group-item"><a class="mytip" href="#">tip</a><a href="$1">_page.$2</a>'
    html = F.regexp_replace("html", r'<li><a href="([^"]*)">([^<]*)</a>', item)
    pages = table(spark, sf_dir, "pages").select(
        F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("category"),
        F.replace(html, F.lit("<ul>"), F.lit('<ul class="nav list-group">')).alias("html"),
    )
    requirements = inline_rows(
        spark,
        [("de", "*"), ("fr", "*"), ("en", "named"), ("de", "extra")],
        "category string, attribute string",
    )
    return build_registry(pages, requirements).select("category", "attribute", "ordinal")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS VARCHAR) AS id,
      string_split(text, chr(10))[i] AS details,
      TRY_CAST(length(string_split(text, chr(10))[i]) AS INTEGER) AS pdbx_number_of_molecules,
      CAST(NULL AS DOUBLE) AS formula_weight
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""
)
def struct_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External JSON with a category as a struct of arrays, exploded by position, inserted by
    name into a bronze table, cast and inserted by name into a silver one."""
    spec = default_registry()["entity"]
    lines = F.split("text", "\n")
    raw = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("experiment_id"),
        F.struct(
            F.transform(lines, lambda _, i: i.cast("string")).alias("id"),
            lines.alias("details"),
            F.transform(lines, lambda line: F.length(line).cast("string")).alias(
                "pdbx_number_of_molecules"
            ),
        ).alias("_entity"),
    )
    paths = {side: work_path(spark, side) for side in ("raw", "bronze", "silver")}
    names = {side: "siftspark_" + path.rsplit("-", 1)[1] for side, path in paths.items()}
    raw.write.json(paths["raw"])
    try:
        stored = create_json_table(spark, names["raw"], paths["raw"], raw.schema)
        create_table(spark, names["bronze"], spec.bronze_schema(), paths["bronze"])
        append_by_name(explode_category(stored, spec), names["bronze"])
        create_table(spark, names["silver"], spec.silver_schema(), paths["silver"])
        bronze = spark.table(names["bronze"])
        append_by_name(
            bronze.select(
                *[F.col(c.name).try_cast(c.spark_type).alias(c.name) for c in spec.columns]
            ),
            names["silver"],
        )
    finally:
        for name in names.values():
            drop_table(spark, name)
    silver = spark.read.schema(spec.silver_schema()).parquet(paths["silver"])
    return silver.select(
        "experiment",
        "id",
        "details",
        "pdbx_number_of_molecules",
        F.col("formula_weight").cast("double").alias("formula_weight"),
    )
