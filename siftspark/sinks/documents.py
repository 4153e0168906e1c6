"""Document sinks: one job for all experiments, the experiment as a column."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.operators.reshape import table_rows
from siftspark.session import open_store

FOLDER_FILES = 1000  # text files in one folder


def write_raw(raw: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """Raw documents `{experiment, etag, data}`, one JSON line each.

    `data` is a tree (maps, structs, variants) or the JSON text of one. Uncompressed lines
    can be read by several tasks per file, which gzip would not allow.
    """
    if raw.schema["data"].dataType != T.StringType():
        documents = raw.select("experiment", "etag", "data")
        documents.write.mode(mode).json(path, compression=compression)
        return
    rest = F.substr(F.to_json(F.struct("experiment", "etag")), F.lit(2))
    line = F.concat(F.lit('{"data":'), "data", F.lit(","), rest)
    raw.select(line).write.mode(mode).text(path, compression=compression)


def write_category_documents(
    documents: DataFrame, root: str, mode: str = "overwrite", even: bool = True
) -> None:
    """Category documents with their number of rows, one directory per category.

    A directory per experiment as well would mean one small file for each pair, so the
    experiment stays a column. REBALANCE evens out file sizes; a large category is spread
    over many files. Without `even` every task writes what it has, and no document is shuffled:
    for folders that are read once and removed.
    """
    rows = documents.select(
        "experiment", "category", "attributes", table_rows(F.col("attributes")).alias("n_rows")
    )
    if even:
        rows.hint("rebalance", "category").write.mode(mode).partitionBy("category").parquet(root)
    else:
        rows.write.mode(mode).partitionBy("category").option("compression", "zstd").parquet(root)


def write_texts(texts: DataFrame, path: str, mode: str = "append") -> None:
    """Source texts (experiment, etag, text); a table, since text files would lose borders."""
    texts.select("experiment", "etag", "text").write.mode(mode).parquet(path)


def write_text_files(texts: DataFrame, path: str, text: str = "text", gzip: bool = False) -> None:
    """Every row's text as a file of its own below the path, `part-<task>-<row>.txt`, or `.txt.gz`.

    Tasks write the files where they belong, in folders of `FOLDER_FILES`. Spark's writer, which takes a
    partition for each file, has a folder, a commit and a sort by the file's name to pay for each. A task that
    is tried again writes the same files again, so the texts should come in an order of their own, as from a table.
    """
    path = path.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(path)
        task, n = TaskContext.get().partitionId(), 0
        compression, suffix = ("gzip", ".txt.gz") if gzip else (None, ".txt")
        for batch in batches:
            for cell in batch.column(0):
                folder = f"{root}/{task:05d}-{n // FOLDER_FILES:05d}"
                if n % FOLDER_FILES == 0:
                    store.create_dir(folder)
                name = f"{folder}/part-{task:05d}-{n:09d}{suffix}"
                with store.open_output_stream(name, compression=compression) as file:
                    file.write((cell.as_py() or b"") + b"\n")
                n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    store, root = open_store(path)
    store.create_dir(root)
    texts.select(F.col(text).cast("binary")).mapInArrow(write, "files long").agg(F.sum("files")).collect()
