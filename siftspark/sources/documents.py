"""JSON documents: raw ones (`{experiment, data, etag}`) and those of one category."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.functions import (
    attribute_arrays,
    experiment_of_code_file,
    leaf_array,
    strip_prefix,
)
from siftspark.operators.scope import broadcast_if_small, in_scope
from siftspark.registry import Registry
from siftspark.sources.mmcif import DATA_TYPE

# One row per (category, experiment); the category is the partition. `n_rows` is NULL for
# attributes of unequal length.
LANDING = "experiment string, attributes map<string,array<string>>, n_rows int, category string"

# What the JSON parser could not read, as it stands in the file.
CORRUPT = "_corrupt_record"

_ATTRIBUTES = T.MapType(T.StringType(), T.VariantType())


def raw_schema(categories: Iterable[str] | None = None) -> T.StructType:
    """Explicit schema of a raw document, so one attribute may be a scalar here, an array there.

    With categories named, only these are declared and the JSON parser skips all others.
    """
    if categories is None:
        data: T.DataType = T.MapType(T.StringType(), _ATTRIBUTES)
    else:
        data = T.StructType(
            [T.StructField(p + c, _ATTRIBUTES) for c in categories for p in ("_", "")]
        )
    schema = T.StructType().add("experiment", T.StringType()).add("data", data)
    return schema.add("etag", T.StringType()).add(CORRUPT, T.StringType())


def named_experiment() -> Column:
    """The experiment written in the document, or else the code its file is named by.

    NULL if a document names none and its file's name is no code.
    """
    named = experiment_of_code_file(F.col("_metadata.file_name"))
    return F.upper(F.coalesce("experiment", named))


def _scan(spark: SparkSession, path: str, names: list[str] | None) -> DataFrame:
    reader = spark.read.schema(raw_schema(names)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path, recursiveFileLookup=True)


def as_map(data: Column, categories: Iterable[str]) -> Column:
    pairs = [
        part
        for c in categories
        for part in (F.lit(c), F.coalesce(data.getField(f"_{c}"), data.getField(c)))
    ]
    return F.map_filter(F.create_map(*pairs), lambda _, attributes: attributes.isNotNull())


def read_raw_json(
    spark: SparkSession, path: str, categories: Iterable[str] | None = None
) -> DataFrame:
    """Raw documents as (experiment, etag, data).

    The experiment is the one written in the document; documents that do not name it take
    the code their file is named by. Lines that are no JSON, and documents without either,
    are not among them: `unread_raw_json` lists those.
    """
    names = None if categories is None else list(categories)
    raw = _scan(spark, path, names).withColumn("_named", named_experiment())
    data = F.col("data") if names is None else as_map(F.col("data"), names)
    return raw.filter(F.col(CORRUPT).isNull() & F.col("_named").isNotNull()).select(
        F.col("_named").alias("experiment"), "etag", data.alias("data")
    )


def unread_raw_json(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason, document) of what `read_raw_json` leaves out: corrupt lines with their
    text, and documents of no known experiment."""
    raw = _scan(spark, path, None).withColumn("_named", named_experiment())
    corrupt = F.col(CORRUPT).isNotNull()
    return raw.filter(corrupt | F.col("_named").isNull()).select(
        F.col("_metadata.file_path").alias("file"),
        F.when(corrupt, "corrupt").otherwise("no experiment").alias("reason"),
        F.coalesce(CORRUPT, F.to_json("data")).alias("document"),
    )


def raw_versions(spark: SparkSession, path: str) -> DataFrame:
    """(experiment, etag) of every raw document; the data is not parsed."""
    return read_raw_json(spark, path, []).select("experiment", "etag")


def json_path(spark: SparkSession, path: str) -> DataFrame:
    """Query a JSON path directly, with the schema Spark infers."""
    return spark.sql("SELECT * FROM json.`" + path.replace("`", "``") + "`")


def category_documents(raw: DataFrame, registry: Registry) -> DataFrame:
    """Raw documents to one row (experiment, category, attributes) per registered category.

    Category names lose their leading underscore, unregistered categories and attributes
    are pruned, and a category with nothing left is no document. The registry is joined as
    rows, of measured size; broadcast, as it is at any size a dictionary has, it moves no
    document.
    """
    spark = raw.sparkSession
    known = spark.createDataFrame(
        [(c.name, c.attributes) for c in registry], "category string, _known array<string>"
    )
    return (
        raw.select("experiment", F.explode("data").alias("_name", "_raw"))
        .select("experiment", strip_prefix(F.col("_name")).alias("category"), "_raw")
        .join(broadcast_if_small(known), "category")
        .select(
            "experiment",
            "category",
            F.map_filter(
                "_raw", lambda name, _: F.array_contains(F.col("_known"), name)
            ).alias("_raw"),
        )
        .filter(F.size("_raw") > 0)
        .select("experiment", "category", attribute_arrays(F.col("_raw")).alias("attributes"))
    )


def raw_eav(raw: DataFrame) -> DataFrame:
    """Raw documents to rows (experiment, category, attribute, values)."""
    return (
        raw.select("experiment", F.explode("data").alias("category", "_attributes"))
        .select(
            "experiment",
            strip_prefix(F.col("category")).alias("category"),
            F.explode("_attributes").alias("attribute", "_leaf"),
        )
        .select("experiment", "category", "attribute", leaf_array(F.col("_leaf")).alias("values"))
    )


def read_category(
    spark: SparkSession, root: str, category: str, scope: DataFrame | None = None
) -> DataFrame:
    """Documents of one category (a partition of the landing folder), in scope only."""
    documents = (
        spark.read.schema(LANDING)
        .parquet(root)
        .filter(F.col("category") == category)
        .select("experiment", "attributes", "n_rows")
    )
    return documents if scope is None else in_scope(documents, scope, category)


__all__ = [
    "DATA_TYPE",
    "LANDING",
    "category_documents",
    "json_path",
    "raw_eav",
    "raw_schema",
    "raw_versions",
    "read_category",
    "read_raw_json",
    "unread_raw_json",
]
