from siftspark.plans.bronze import build_bronze, replace_chunks
from siftspark.plans.ingest import (
    land_raw,
    plan_ingest,
    read_landed,
    read_scope,
    read_versions,
    record_versions,
)
from siftspark.plans.layout import Layout
from siftspark.plans.ledger import queue_inputs, read_ledger, refine_pending
from siftspark.plans.legacy import explode_category
from siftspark.plans.quarantine import read_quarantine
from siftspark.plans.refine import refine
from siftspark.plans.schema import build_registry, write_registry
from siftspark.plans.silver import audit, build_silver

__all__ = [
    "Layout",
    "audit",
    "build_bronze",
    "build_registry",
    "build_silver",
    "explode_category",
    "land_raw",
    "plan_ingest",
    "queue_inputs",
    "read_landed",
    "read_ledger",
    "read_quarantine",
    "read_scope",
    "read_versions",
    "record_versions",
    "refine",
    "refine_pending",
    "replace_chunks",
    "write_registry",
]
