"""Parquet tables that can be updated by experiment.

A table is divided by a hash bucket of its experiment. A merge or replacement reads the buckets
that the run touches and writes them once, into a new folder. Files are never changed: a small file
per version names the folder that holds each bucket, and a change takes effect when the file of the
next version appears, as a whole and only if no other writer was first. So a reader sees one version
from end to end and changes nothing, whatever writers do meanwhile, and a writer that dies leaves the
table as it was. Folders that only versions before the last two name are removed.

The number of buckets is part of their name (`bucket_64`), so a table cannot be opened with another
number. Within the write, REBALANCE splits a bucket that a hot experiment has made large over as
many tasks and files as its size asks for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.functions import bucket
from siftspark.operators.constraints import assert_present, assert_unique
from siftspark.operators.keys import distinct_keys
from siftspark.operators.merge import merge_upsert, replace_by_key
from siftspark.registry import LINEAGE
from siftspark.session import discard, entries, publish, read_text

BUCKETS = 64
VERSIONS = "_versions"
KEPT = 2  # versions whose folders stay, for readers that began before a change


class TableChanged(RuntimeError):
    """Another writer was first; what this one read is out of date."""


def bucket_column(n: int = BUCKETS) -> str:
    return f"bucket_{n}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name) for name in entries(spark, f"{path}/{VERSIONS}") if name.isdigit()]


def _folders(spark: SparkSession, path: str, number: int, n: int = BUCKETS) -> dict[int, str]:
    """The folder of each bucket in a version; version 0 has none."""
    if not number:
        return {}
    version = json.loads(read_text(spark, f"{path}/{VERSIONS}/{number:08d}"))
    if version["buckets"] != bucket_column(n):
        raise ValueError(f"{path} is not divided by {bucket_column(n)} but by {version['buckets']}")
    return {int(b): folder for b, folder in version["folders"].items()}


def _current(spark: SparkSession, path: str, n: int) -> tuple[int, dict[int, str]]:
    number = max(_numbers(spark, path), default=0)
    return number, _folders(spark, path, number, n)


def _rows(
    spark: SparkSession, path: str, schema: T.StructType, folders: dict[int, str], of: Iterable[int], n: int
) -> DataFrame:
    held = [f"{path}/{folders[b]}/{bucket_column(n)}={b}" for b in sorted(of) if b in folders]
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*held)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    n: int = BUCKETS,
    of: DataFrame | None = None,
) -> DataFrame:
    """The table's rows as of now; none if it has not been written yet.

    With `of`, a list of experiments, only the buckets they fall into are scanned.
    """
    path = path.rstrip("/")
    _, folders = _current(spark, path, n)
    wanted = folders if of is None or not folders else _buckets_of(of, n)
    return _rows(spark, path, schema, folders, wanted, n)


def _write(df: DataFrame, path: str, number: int, folders: dict[int, str], touched: set[int], n: int) -> None:
    """Write the rows into a new folder, and make them the touched buckets of the next version."""
    spark, name, folder = df.sparkSession, bucket_column(n), f"rows-{uuid.uuid4().hex}"
    with_bucket = df.withColumn(name, bucket(F.col(LINEAGE), n))
    with_bucket.hint("rebalance", name).write.partitionBy(name).parquet(f"{path}/{folder}")
    made = {int(x.removeprefix(f"{name}=")): folder for x in entries(spark, f"{path}/{folder}") if x.startswith(name)}
    after = {b: f for b, f in folders.items() if b not in touched} | made
    version = json.dumps({"buckets": name, "folders": after})
    if not publish(spark, f"{path}/{VERSIONS}/{number + 1:08d}", version):
        discard(spark, f"{path}/{folder}")
        raise TableChanged(f"{path} has a version {number + 1} already; read it and change it again")
    _forget(spark, path, n)


def _forget(spark: SparkSession, path: str, n: int) -> None:
    """Remove the versions before those that are kept, and the folders that only they name."""
    numbers = sorted(_numbers(spark, path))
    old, kept = numbers[:-KEPT], numbers[-KEPT:]
    used = {f for number in kept for f in _folders(spark, path, number, n).values()}
    for number in old:
        for folder in set(_folders(spark, path, number, n).values()) - used:
            discard(spark, f"{path}/{folder}")
        discard(spark, f"{path}/{VERSIONS}/{number:08d}")


def vacuum(spark: SparkSession, path: str, n: int = BUCKETS) -> None:
    """Remove folders that no version names, which writers left that died; no writer may be at work."""
    path = path.rstrip("/")
    used = {f for number in _numbers(spark, path) for f in _folders(spark, path, number, n).values()}
    for folder in entries(spark, path):
        if folder.startswith("rows-") and folder not in used:
            discard(spark, f"{path}/{folder}")


def write_table(df: DataFrame, path: str, n: int = BUCKETS) -> None:
    """First load: the rows become the content of their buckets."""
    path = path.rstrip("/")
    number, folders = _current(df.sparkSession, path, n)
    _write(df, path, number, folders, set(), n)


def _buckets_of(df: DataFrame, n: int) -> set[int]:
    """Buckets that the rows' experiments fall into: at most n numbers."""
    return {r["b"] for r in df.select(bucket(F.col(LINEAGE), n).alias("b")).distinct().collect()}


def _rewrite(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    touched: set[int],
    combine: Callable[[DataFrame], DataFrame],
    n: int,
) -> None:
    """Replace the touched buckets by what `combine` makes of them."""
    if not touched:
        return
    path = path.rstrip("/")
    number, folders = _current(spark, path, n)
    after = combine(_rows(spark, path, schema, folders, touched, n))
    _write(after.select(*schema.fieldNames()), path, number, folders, touched, n)


def merge_into(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    n: int = BUCKETS,
    checked: bool = False,
) -> None:
    """Upsert by key. The keys include the experiment; `source` should be a written table,
    as it is read for the touched buckets, for its keys and for its rows.

    Refused before anything is written: NULL in a column that the schema doesn't let be NULL, and
    several source rows for one key. With `null_safe`, keys may be incomplete and then stand for
    several rows, so only the columns are looked at. `checked` says that the caller has made sure."""
    if LINEAGE not in keys:
        raise ValueError(f"merge keys must include {LINEAGE}: {keys}")
    if not checked:
        assert_present(source, [f.name for f in schema.fields if not f.nullable])
        if not null_safe:
            assert_unique(source, keys)

    def combine(current: DataFrame) -> DataFrame:
        return merge_upsert(current, source, keys, null_safe)

    _rewrite(spark, path, schema, _buckets_of(source, n), combine, n)


def _keeps_some(current: DataFrame, listed: DataFrame) -> bool:
    """Whether rows stay beside the listed experiments. If none do, as in a replay, no row need be shuffled."""
    return not current.select(LINEAGE).distinct().join(distinct_keys(listed.select(LINEAGE)), LINEAGE, "left_anti").isEmpty()


def replace_experiments(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    listed: DataFrame | None = None,
    filled: DataFrame | None = None,
    n: int = BUCKETS,
) -> None:
    """All rows of the listed experiments (by default the source's) are replaced.

    `filled` may name the experiments that the source has rows of, where that is known
    without computing the rows.
    """
    touched = _buckets_of(source if filled is None else filled, n)
    if listed is not None:
        touched |= _buckets_of(listed, n)

    def combine(current: DataFrame) -> DataFrame:
        if listed is not None and not _keeps_some(current, listed):
            current = spark.createDataFrame([], schema)
        return replace_by_key(current, source, LINEAGE, listed)

    _rewrite(spark, path, schema, touched, combine, n)
