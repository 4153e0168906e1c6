from siftspark.operators.constraints import assert_unique, null_violations, pk_violations, require_rows
from siftspark.operators.merge import merge_upsert, replace_by_key
from siftspark.operators.quality import accepted, flag, reasons, rejected, rules, split, typed
from siftspark.operators.ranking import row_numbers
from siftspark.operators.reshape import (
    arrays_to_rows,
    collect_columns,
    conform,
    enrich_documents,
    enrich_eav,
    expand_requirements,
    explode_indexed,
    max_array_len,
    null_tokens,
    prune_to_schema,
    ragged,
    transpose_broadcast,
    union_all,
)
from siftspark.operators.scope import build_scope, changed, in_scope, latest_versions, version_status

__all__ = [
    "accepted",
    "arrays_to_rows",
    "assert_unique",
    "build_scope",
    "changed",
    "collect_columns",
    "conform",
    "enrich_documents",
    "enrich_eav",
    "expand_requirements",
    "explode_indexed",
    "flag",
    "in_scope",
    "latest_versions",
    "max_array_len",
    "merge_upsert",
    "null_tokens",
    "null_violations",
    "pk_violations",
    "prune_to_schema",
    "ragged",
    "reasons",
    "rejected",
    "replace_by_key",
    "require_rows",
    "row_numbers",
    "rules",
    "split",
    "transpose_broadcast",
    "typed",
    "union_all",
    "version_status",
]
