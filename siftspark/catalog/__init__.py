"""Registered queries: one per operator, each over whole tables, with the SQL to check it."""

from siftspark.catalog import (
    categories,
    ingest,
    merging,
    plans,
    quality,
    reshaping,
    scalars,
    sinks,
    sources,
    streams,
)
from siftspark.catalog.base import ORACLE, QUERIES

__all__ = [
    "ORACLE",
    "QUERIES",
    "categories",
    "ingest",
    "merging",
    "plans",
    "quality",
    "reshaping",
    "scalars",
    "sinks",
    "sources",
    "streams",
]
