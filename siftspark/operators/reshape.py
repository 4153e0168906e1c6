"""Shape changes: columns of arrays to rows, conforming to a schema, pruning and enriching.

Documents are reshaped inside their own row (map and array expressions plus one generator),
so none of these needs a shuffle unless it says so.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.functions import null_if_token
from siftspark.functions.text import MISSING
from siftspark.registry import Registry

_EMPTY = "array<string>"


def null_tokens(df: DataFrame, tokens: tuple[str, ...] = MISSING) -> DataFrame:
    """NULL for cells that consist of a missing-value token, in every string column."""
    return df.select(
        *[
            null_if_token(F.col(f.name), tokens).alias(f.name)
            if f.dataType.typeName() == "string"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, names: Iterable[str], **literals: str) -> DataFrame:
    """Exactly these columns in this order, as strings; absent ones are NULL or the literal."""
    present = set(df.columns)

    def column(name: str) -> Column:
        if name in literals:
            return F.lit(literals[name]).alias(name)
        return (F.col(name) if name in present else F.lit(None)).cast("string").alias(name)

    return df.select(*map(column, names))


def _lengths(attributes: Column) -> Column:
    return F.transform(F.map_values(attributes), lambda values: F.size(values))


def ragged(attributes: Column) -> Column:
    """Are the attributes of unequal length, so that they form no table?"""
    return F.array_min(_lengths(attributes)) != F.array_max(_lengths(attributes))


def table_rows(attributes: Column) -> Column:
    """Number of rows the attributes form; NULL if they form no table."""
    return F.when(~ragged(attributes), F.array_max(_lengths(attributes)))


def arrays_to_rows(
    documents: DataFrame, names: Iterable[str], keys: Iterable[str], attributes: str = "attributes"
) -> DataFrame:
    """Map of attribute arrays to one row per array position.

    Check `ragged` first: shorter arrays would be filled up with NULL.
    """
    names, keys = list(names), list(keys)
    zipped = F.arrays_zip(
        *[
            F.coalesce(F.try_element_at(attributes, F.lit(n)), F.array().cast(_EMPTY)).alias(n)
            for n in names
        ]
    )
    return documents.select(*keys, F.explode(zipped).alias("_row")).select(
        *keys, *[F.col("_row").getField(n).alias(n) for n in names]
    )


def explode_indexed(
    df: DataFrame, arrays: Iterable[str], keys: Iterable[str], position: str | None = None
) -> DataFrame:
    """Parallel array columns to rows, each value taken at the row's own position."""
    arrays, keys = list(arrays), list(keys)
    rows = df.select(
        *keys,
        F.posexplode(
            F.arrays_zip(*[F.coalesce(F.col(a), F.array().cast(_EMPTY)).alias(a) for a in arrays])
        ).alias("_pos", "_row"),
    )
    index = [] if position is None else [F.col("_pos").alias(position)]
    return rows.select(*keys, *index, *[F.col("_row").getField(a).alias(a) for a in arrays])


def transpose_broadcast(
    documents: DataFrame,
    names: Iterable[str],
    keys: Iterable[str],
    attributes: str = "attributes",
    drop: Iterable[str] = (),
    position: str = "line",
) -> DataFrame:
    """As `arrays_to_rows`, but an attribute shorter than the longest repeats its first value.

    An empty attribute gives NULL. Dropped attributes still count for the length.
    """
    skipped = set(drop)
    names, keys = [n for n in names if n not in skipped], list(keys)
    longest = F.array_max(_lengths(F.col(attributes)))

    def full(n: str) -> Column:
        values = F.try_element_at(attributes, F.lit(n))
        first = F.get(values, F.lit(0))
        return F.when(F.size(values) == longest, values).otherwise(F.array_repeat(first, longest))

    return documents.select(
        *keys, F.posexplode(F.arrays_zip(*[full(n).alias(n) for n in names])).alias(position, "_row")
    ).select(*keys, position, *[F.col("_row").getField(n).alias(n) for n in names])


def max_array_len(df: DataFrame, arrays: Iterable[str], name: str = "max_len") -> DataFrame:
    """Length of the longest array in any of the columns."""
    sizes = [F.size(a) for a in arrays]
    return df.agg(F.max(F.greatest(*sizes) if len(sizes) > 1 else sizes[0]).alias(name))


def collect_columns(
    df: DataFrame, keys: list[str], position: str, columns: list[str], chunk_rows: int = 1024
) -> DataFrame:
    """Columns to lists, in chunks: one row per key and run of `chunk_rows` positions.

    `position` counts 0, 1, ... within the key (see `row_numbers`), so a list never holds
    more than `chunk_rows` values however many rows a key has, and no value is left out.
    """
    chunk = F.floor(F.col(position) / F.lit(chunk_rows)).cast("bigint")
    rows = F.sort_array(F.collect_list(F.struct(position, *columns)))
    grouped = df.groupBy(*keys, chunk.alias("chunk")).agg(rows.alias("_rows"))
    return grouped.select(*keys, "chunk", *[F.col("_rows").getField(c).alias(c) for c in columns])


def prune_to_schema(eav: DataFrame, registry: Registry) -> DataFrame:
    """Rows (…, category, attribute, …) whose attribute is registered.

    The registry is a local relation of bounded size, which Catalyst broadcasts.
    """
    known = registry.frame(eav.sparkSession).select("category", "attribute")
    return eav.join(known, ["category", "attribute"], "left_semi").select(*eav.columns)


def enrich_eav(eav: DataFrame, registry: Registry) -> DataFrame:
    """Every registered attribute of every experiment; absent ones with empty values.

    Values already there win. The registry is exploded from a literal, next to each
    experiment; the join back is on the full key, which is unique.
    """
    known = F.array(
        *[
            F.struct(F.lit(c.name).alias("category"), F.lit(a).alias("attribute"))
            for c in registry
            for a in c.attributes
        ]
    )
    wanted = eav.select("experiment").distinct().select("experiment", F.inline(known))
    found = eav.select("experiment", "category", "attribute", "values")
    return wanted.join(found, ["experiment", "category", "attribute"], "left").withColumn(
        "values", F.coalesce("values", F.array().cast(_EMPTY))
    )


def enrich_documents(data: Column, registry: Registry) -> Column:
    """Same for a map category -> attribute -> values, within its row."""

    def attributes_of(category) -> Column:
        names = F.array(*map(F.lit, category.attributes))
        found = F.try_element_at(data, F.lit(category.name))
        values = F.transform(
            names, lambda n: F.coalesce(F.try_element_at(found, n), F.array().cast(_EMPTY))
        )
        return F.map_from_arrays(names, values)

    return F.create_map(*[p for c in registry for p in (F.lit(c.name), attributes_of(c))])


def expand_requirements(requirements: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Required (category, attribute) pairs: '*' means all that the dictionary lists.

    Attributes asked for by name come after those of the dictionary.
    """
    whole = requirements.filter(F.col("attribute") == "*").select("category").distinct()
    named = requirements.filter(F.col("attribute") != "*").select("category", "attribute")
    listed = dictionary.join(whole, "category", "left_semi").select(
        "category", "attribute", "ordinal"
    )
    return (
        listed.unionByName(named.withColumn("ordinal", F.lit(2**31 - 1)))
        .groupBy("category", "attribute")
        .agg(F.min("ordinal").alias("ordinal"))
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
