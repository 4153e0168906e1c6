"""What several operators share: staging, words, and file access for tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from siftspark.session import open_store, staged

__all__ = ["GAP", "WORD", "held_out", "let", "open_store", "slices", "staged", "text_of", "word_count", "words_of"]

# Fixed value: a word is a run of characters that are neither blank nor TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task holds beside the texts stays small.

    A Python worker lives on after its task: what Arrow kept for reuse is given back at the end.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def text_of(column: str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words as an array; blank texts have none."""
    # A text that begins or ends with a gap gives an empty first or last piece.
    return F.array_remove(F.split(text, GAP), "")


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id's digits falls into the fold that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
