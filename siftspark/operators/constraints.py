"""Constraints that are checked, not only declared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The same rows; raises if there are none."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def pk_violations(df: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; raises and names keys if rows that differ share one."""
    clashes = pk_violations(df, keys).limit(5).collect()
    if clashes:
        shown = "; ".join(", ".join(f"{k}={row[k]!r}" for k in keys) for row in clashes)
        raise ValueError(f"several source rows for one key ({', '.join(keys)}): {shown}")
    return df


def assert_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows; raises and names the columns if one that must be filled has NULLs."""
    if columns:
        missing = null_violations(df, columns).filter("n_null > 0").collect()  # a row per column at most
        if missing:
            shown = ", ".join(f"{row['column']} ({row['n_null']} rows)" for row in missing)
            raise ValueError(f"NULL in required columns: {shown}")
    return df


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (column, n_null) per required column, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns]
    )
    return counts.select(F.inline(pairs))
