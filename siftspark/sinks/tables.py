"""Catalog tables: DDL from a schema, appends, truncation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _quoted(table: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in table.split("."))


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    path: str | None = None,
    replace: bool = False,
    if_not_exists: bool = False,
) -> None:
    """Parquet table with the schema's columns, NOT NULL where the schema says so.

    Spark does not enforce NOT NULL or a key on files; `null_violations` and
    `assert_unique` check them. `replace` drops the table and then creates it, so a failure in
    between leaves none; what an external table's folder holds stays either way.
    """
    if replace:
        drop_table(spark, table)
    columns = ", ".join(
        f"{_quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    exists = "IF NOT EXISTS " if if_not_exists else ""
    location = ""
    if path:
        literal = path.replace("\\", "\\\\").replace("'", "\\'")
        location = f" LOCATION '{literal}'"
    spark.sql(f"CREATE TABLE {exists}{_quoted(table)} ({columns}) USING parquet{location}")


def create_json_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """External table over a folder of JSON."""
    return spark.catalog.createTable(table, path, "json", schema)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")


def truncate(spark: SparkSession, table: str) -> None:
    """Empty a table, also an external one, which TRUNCATE TABLE refuses."""
    nothing = spark.createDataFrame([], spark.table(table).schema)
    nothing.write.insertInto(table, overwrite=True)


def append_positional(df: DataFrame, table: str) -> None:
    """Columns are matched by position."""
    df.write.insertInto(table, overwrite=False)


def append_by_name(df: DataFrame, table: str) -> None:
    """Columns are matched by name; those the table has and the rows lack become NULL."""
    df.sparkSession.sql(f"INSERT INTO {_quoted(table)} BY NAME SELECT * FROM {{rows}}", rows=df)


def append_rows(spark: SparkSession, rows: Iterable[tuple], table: str) -> None:
    """Literal rows into a control table, in its column order."""
    append_positional(spark.createDataFrame(list(rows), spark.table(table).schema), table)


def truncate_reload(df: DataFrame, table: str) -> None:
    """The rows become the table's only ones, in one commit. They must not be read from it."""
    df.sparkSession.sql(
        f"INSERT OVERWRITE {_quoted(table)} BY NAME SELECT * FROM {{rows}}", rows=df
    )
