from siftspark.sinks.documents import write_category_documents, write_raw, write_text_files, write_texts
from siftspark.sinks.tables import (
    append_by_name,
    append_positional,
    append_rows,
    create_json_table,
    create_table,
    drop_table,
    truncate,
    truncate_reload,
)
from siftspark.sinks.buckets import (
    TableChanged,
    bucket_column,
    merge_into,
    read_table,
    replace_experiments,
    vacuum,
    write_table,
)

__all__ = [
    "TableChanged",
    "append_by_name",
    "append_positional",
    "append_rows",
    "bucket_column",
    "create_json_table",
    "create_table",
    "drop_table",
    "merge_into",
    "read_table",
    "replace_experiments",
    "truncate",
    "truncate_reload",
    "vacuum",
    "write_category_documents",
    "write_raw",
    "write_table",
    "write_text_files",
    "write_texts",
]
