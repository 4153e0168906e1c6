"""File streams, run until all files present are in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.catalog.base import query, table
from siftspark.catalog.plans import BUCKETS, SOURCED, sourced_texts
from siftspark.catalog.sources import DOCUMENTS, document_texts
from siftspark.plans import Layout, read_quarantine
from siftspark.session import work_path
from siftspark.sinks import read_table, write_raw
from siftspark.sources import parse_mmcif, unread_raw_json
from siftspark.streaming import stream_files, stream_inferred, stream_raw, stream_to_bronze


@query("SELECT event_id, event_type, value FROM events")
def stream_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals, three runs: every file is taken once."""
    landing, out, seen = (work_path(spark, name) for name in ("landing", "stream", "seen"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")

    def run() -> None:
        files = stream_files(spark, landing, events.schema)
        sink = files.writeStream.format("parquet").option("checkpointLocation", seen)
        sink.trigger(availableNow=True).start(out).awaitTermination()

    events.filter("event_type = 'click'").write.mode("append").json(landing)
    run()
    events.filter("event_type <> 'click'").write.mode("append").json(landing)
    run()
    run()
    return spark.read.schema(events.schema).parquet(out)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, CAST(i - 1 AS VARCHAR) AS no,
      CAST(length(string_split(text, chr(10))[i]) AS VARCHAR) AS n_chars
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)"""
)
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents as a stream into the bronze tables; a replay changes nothing."""
    landing = work_path(spark, "raw")
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    write_raw(parse_mmcif(document_texts(spark, sf_dir), as_json=True), landing)
    stream = stream_raw(spark, landing, categories=DOCUMENTS.names)
    for seen in (work_path(spark, "seen"), work_path(spark, "replay")):
        stream_to_bronze(stream, layout, DOCUMENTS, seen).awaitTermination()
    schema = DOCUMENTS["line"].bronze_schema()
    return read_table(spark, layout.bronze("line"), schema, BUCKETS)


def _broken(documents: DataFrame) -> DataFrame:
    """One line of JSON per document, cut off in the middle."""
    start = F.concat(F.lit('{"experiment": "'), F.col("doc_id").cast("string"), F.lit('", "data": {'))
    return documents.select(start)


@query(
    """SELECT 'corrupt' AS reason, '{"experiment": "' || doc_id || '", "data": {' AS document
    FROM documents WHERE lang = 'fr'"""
)
def corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Among good documents, the French ones are lines cut off in the middle."""
    landing, documents = work_path(spark, "raw"), table(spark, sf_dir, "documents")
    good = parse_mmcif(sourced_texts(documents.filter("lang <> 'fr'")), as_json=True)
    write_raw(good, landing)
    _broken(documents.filter("lang = 'fr'")).write.mode("append").text(landing)
    return unread_raw_json(spark, landing).select("reason", "document")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS experiment, 'ragged' AS reason FROM documents WHERE lang = 'de'
    UNION ALL SELECT NULL, 'corrupt' FROM documents WHERE lang = 'fr'
    UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL FROM documents WHERE lang NOT IN ('de', 'fr')"""
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German documents of uneven length and corrupt French lines, each set aside by the stream."""
    landing, documents = work_path(spark, "raw"), table(spark, sf_dir, "documents")
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    ragged = F.when(F.col("lang") == "de", F.col("lang"))
    write_raw(parse_mmcif(sourced_texts(documents.filter("lang <> 'fr'"), ragged), as_json=True), landing)
    _broken(documents.filter("lang = 'fr'")).write.mode("append").text(landing)
    stream = stream_raw(spark, landing, categories=SOURCED.names)
    stream_to_bronze(stream, layout, SOURCED, work_path(spark, "seen")).awaitTermination()
    schema = SOURCED["document"].bronze_schema()
    taken = read_table(spark, layout.bronze("document"), schema, BUCKETS).select("experiment")
    aside = read_quarantine(spark, layout).select("experiment", "reason")
    # The parser may have read a corrupt line's experiment before it broke off.
    name = F.when(F.col("reason") != "corrupt", F.col("experiment"))
    return aside.select(name.alias("experiment"), "reason").unionByName(
        taken, allowMissingColumns=True
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS experiment, lang, 'second' AS source FROM documents")
def stream_latest_in_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of each document as neighbours in one file: the later line stands."""
    landing, documents = work_path(spark, "raw"), table(spark, sf_dir, "documents")
    layout = Layout(work_path(spark, "archive"), BUCKETS)
    versions = documents.withColumn("source", F.explode(F.array("source", F.lit("second"))))
    write_raw(parse_mmcif(sourced_texts(versions), as_json=True), landing)
    stream = stream_raw(spark, landing, categories=SOURCED.names)
    stream_to_bronze(stream, layout, SOURCED, work_path(spark, "seen")).awaitTermination()
    return read_table(spark, layout.bronze("document"), SOURCED["document"].bronze_schema(), BUCKETS)


# What each kind of event says in the second arrival, as JSON text and as the columns that take it.
_DRIFTED = {
    # A new column.
    "view": """concat('{"event_id": ', event_id, ', "detail": {"user": ', user_id, '}, "ts": "', event_type, '"}')""",
    # A new field two levels down, and one in an element of an array.
    "error": """concat('{"event_id": ', event_id, ', "detail": {"user": ', user_id, ', "host": {"port": 1, "up": ',
      event_id, '}}, "tags": [{"name": "a"}, {"name": "b", "rank": ', event_id, '}]}')""",
    # A value that is no such number.
    "signup": """concat('{"event_id": "E', event_id, '", "detail": {"user": ', user_id, '}}')""",
    # A number with digits that its type doesn't hold, and a text where an object was.
    "purchase": """concat('{"event_id": ', event_id, '.25, "detail": "', user_id, '"}')""",
}
_FIRST = """concat('{"event_id": ', event_id, ', "detail": {"user": ', user_id, ', "host": {"port": 1}}, "tags": [{"name": "',
  event_type, '"}]}')"""


@query(
    f"""WITH lines AS (SELECT event_id, user_id, event_type, CASE event_type
      {" ".join(f"WHEN '{kind}' THEN {text}" for kind, text in _DRIFTED.items())} ELSE {_FIRST} END AS line FROM events)
    SELECT CASE WHEN event_type NOT IN ('signup', 'purchase') THEN event_id END AS event_id,
      CASE WHEN event_type <> 'purchase' THEN user_id END AS user_id,
      CASE event_type WHEN 'error' THEN 2 WHEN 'click' THEN 1 END AS tags,
      CASE WHEN event_type <> 'click' THEN line END AS rescued
    FROM lines"""
)
def stream_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema is inferred from the clicks; what the other events say beyond it is rescued."""
    landing, out, seen, kept = (work_path(spark, n) for n in ("landing", "stream", "seen", "schema"))
    events = table(spark, sf_dir, "events")
    drifted = F.lit(None).cast("string")
    for kind, text in _DRIFTED.items():
        drifted = F.when(F.col("event_type") == kind, F.expr(text)).otherwise(drifted)

    def run() -> None:
        stream = stream_inferred(spark, landing, kept)
        sink = stream.writeStream.format("parquet").option("checkpointLocation", seen)
        sink.trigger(availableNow=True).start(out).awaitTermination()

    events.filter("event_type = 'click'").select(F.expr(_FIRST)).write.text(landing)
    run()
    events.filter("event_type <> 'click'").select(drifted).write.mode("append").text(landing)
    run()
    return spark.read.parquet(out).select(
        "event_id", F.col("detail.user").alias("user_id"), F.size("tags").alias("tags"), F.col("_rescued").alias("rescued")
    )
