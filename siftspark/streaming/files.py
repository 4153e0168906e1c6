"""New files, once each, through Structured Streaming's file source."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siftspark.functions import has_nested_leaf, not_held
from siftspark.operators.scope import broadcast_if_small
from siftspark.plans.bronze import replace_documents, set_aside_uneven
from siftspark.plans.layout import Layout
from siftspark.plans.quarantine import set_aside
from siftspark.registry import LINEAGE, Registry
from siftspark.session import discard, exists, staged
from siftspark.sinks.documents import write_category_documents
from siftspark.sources.documents import (
    CORRUPT,
    LANDING,
    as_map,
    category_documents,
    named_experiment,
    raw_schema,
)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "json",
    files_per_batch: int = 1000,
    **options: str,
) -> DataFrame:
    """Files as they arrive, with a stated schema; the checkpoint remembers those seen."""
    return (
        spark.readStream.schema(schema)
        .format(format)
        .options(maxFilesPerTrigger=str(files_per_batch), **options)
        .load(path)
    )


def kept_schema(spark: SparkSession, path: str, kept_at: str) -> T.StructType:
    """The schema of a folder of JSON lines, inferred once from all of it and kept as a file.

    Later runs of a stream use what was kept, so its output keeps one schema.
    """
    if exists(spark, kept_at):
        text = "".join(r["value"] for r in spark.read.text(kept_at).collect())
        return T.StructType.fromJson(json.loads(text))
    schema = spark.read.json(path, recursiveFileLookup=True).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(kept_at)
    return schema


def stream_inferred(
    spark: SparkSession, path: str, kept_at: str, files_per_batch: int = 1000
) -> DataFrame:
    """JSON lines of unknown shape as they arrive, in the kept schema, and `_rescued`.

    A line that says more than the columns hold is in `_rescued` as it stands in the file: one with a
    field at any depth that the kept schema doesn't have, with a value that doesn't fit its type or
    loses digits in it, and one that is no JSON object. NULL there means that the columns say all.
    """
    schema = kept_schema(spark, path, kept_at)
    text = T.StructType().add("value", "string")
    lines = stream_files(
        spark, path, text, "text", files_per_batch, recursiveFileLookup="true"
    )
    said, row = F.try_parse_json("value"), F.col("_row")
    unread = F.try_variant_get(said, "$", "map<string,variant>").isNull()
    parsed = lines.withColumn("_row", F.from_json("value", schema))
    return parsed.select(
        "_row.*", F.when(unread | not_held(said, row, schema), F.col("value")).alias("_rescued")
    )


def stream_raw(
    spark: SparkSession,
    path: str,
    files_per_batch: int = 1000,
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """Raw documents as they arrive: (experiment, etag, data, corrupt, landed_at, file).

    With categories named, the JSON parser skips all others. Corrupt lines come as they stand in
    `corrupt`; the experiment is NULL where neither the document nor its file names it.
    """
    names = None if categories is None else list(categories)
    files = stream_files(
        spark,
        path,
        raw_schema(names),
        files_per_batch=files_per_batch,
        recursiveFileLookup="true",
        columnNameOfCorruptRecord=CORRUPT,
    )
    return files.select(
        named_experiment().alias(LINEAGE),
        "etag",
        (F.col("data") if names is None else as_map(F.col("data"), names)).alias("data"),
        F.col(CORRUPT).alias("corrupt"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part_of_file"),
    )


def _latest(documents: DataFrame) -> DataFrame:
    """The last document of each experiment in a batch: by time, file and place in the file.

    Only experiments that come more than once have their documents shuffled and sorted; which these are,
    counts by experiment tell. If they are most of the batch, it goes that way as a whole.
    """
    counts = staged(documents.groupBy(F.col(LINEAGE).alias("_named")).count(), "arrivals")
    several = counts.filter("count > 1").select("_named")
    total, often = counts.agg(F.sum("count"), F.sum(F.expr("IF(count > 1, count, 0)"))).first()
    columns = [LINEAGE, "etag", "data"]
    if not often:
        return documents.select(*columns)
    if 2 * often > total:
        return _last_of_each(documents)
    several, named = broadcast_if_small(several), F.col(LINEAGE) == F.col("_named")
    once = documents.join(several, named, "left_anti").select(*columns)
    return once.unionByName(_last_of_each(documents.join(several, named, "left_semi")))


def _last_of_each(documents: DataFrame) -> DataFrame:
    arrival = F.struct("landed_at", "file", "part_of_file", "place")
    last = documents.groupBy(LINEAGE).agg(F.max_by(F.struct("etag", "data"), arrival).alias("_last"))
    return last.select(LINEAGE, "_last.*")


def stream_to_bronze(
    stream: DataFrame, layout: Layout, registry: Registry, checkpoint: str
) -> StreamingQuery:
    """Bring every new raw document into the bronze tables; stops when all are in.

    Each micro-batch replaces its experiments, so a batch replayed after a failure leaves
    the same tables. What can't be taken is set aside under the stream's name and the batch:
    corrupt lines, documents of no experiment, with nested objects, or of uneven length.
    """
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landing, run = layout.arrivals(batch_id), f"stream-{name}-{batch_id}"
        nested = F.coalesce(has_nested_leaf(F.col("data")), F.lit(False))
        problem = (
            F.when(F.col("corrupt").isNotNull(), "corrupt")
            .when(F.col(LINEAGE).isNull(), "no experiment")
            .when(nested, "nested")
        )
        document = F.coalesce("corrupt", F.to_json("data"))
        set_aside(batch.filter(problem.isNotNull()), layout, run, "files", problem, document)
        # Numbers grow along each part of a file that one task reads; they only ever order.
        read = batch.withColumn("place", F.monotonically_increasing_id())
        read = read.filter(problem.isNull())
        write_category_documents(category_documents(_latest(read), registry), landing, even=False)
        landed = spark.read.schema(LANDING).parquet(landing)
        held = {row["category"] for row in landed.select("category").distinct().collect()}
        for spec in registry:
            if spec.name not in held:
                continue
            documents = landed.filter(F.col("category") == spec.name)
            set_aside_uneven(documents, layout, spec, run)
            replace_documents(spark, layout, spec, documents)
        discard(spark, landing)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
