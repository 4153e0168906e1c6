from siftspark.sources.control import finish_inputs, inline_rows, pending_inputs
from siftspark.sources.dictionary import dictionary_links, page_links
from siftspark.sources.documents import (
    category_documents,
    json_path,
    raw_eav,
    raw_schema,
    read_category,
    read_raw_json,
    unread_raw_json,
    raw_versions,
)
from siftspark.sources.mmcif import even_chunks, parse_mmcif, parse_mmcif_chunks, read_mmcif
from siftspark.sources.mmcif_files import register_mmcif
from siftspark.sources.text import read_id_list

__all__ = [
    "category_documents",
    "dictionary_links",
    "even_chunks",
    "finish_inputs",
    "inline_rows",
    "json_path",
    "page_links",
    "parse_mmcif",
    "parse_mmcif_chunks",
    "pending_inputs",
    "raw_eav",
    "raw_schema",
    "raw_versions",
    "read_category",
    "read_id_list",
    "read_mmcif",
    "read_raw_json",
    "register_mmcif",
    "unread_raw_json",
]
