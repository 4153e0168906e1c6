"""mmCIF files as a data source: `spark.read.format("mmcif").load(folder)`.

Rows are chunks of categories, (experiment, file, block, category, first_row, attributes). A task
reads its files line by line, so a file of any size is neither one string nor one row; small
files share a task, and each counts `FILE_BYTES` on top of its size for being opened. A filter on `category` reaches the tokeniser, which then keeps no values of other
categories; one on `experiment` leaves out files, where files name it.

Options: `pattern` of file names (`*.cif*`; `.gz` is unpacked), `rows` per chunk (10000), `taskBytes` of
files per task (128 MB), `namedBy` `file` or `block`, which of them the experiment is.
"""

from __future__ import annotations

import fnmatch
import io
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from siftspark.session import open_store
from siftspark.sources.mmcif import CHUNK_COLUMNS, CHUNK_NAMES, Chunk, chunk_columns, parse_lines

FORMAT = "mmcif"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
BATCH_VALUES = 1 << 17
BATCH_CHARS = 1 << 23
FILE_BYTES = 1 << 16


@dataclass
class Files(InputPartition):
    paths: list[str]


def pack(files: Iterable[tuple[str, int]], most: int) -> list[list[str]]:
    """Files in order, as many together as stay within `most` bytes, and each larger one alone."""
    packed: list[list[str]] = []
    room = 0
    for path, size in files:
        if not packed or size > room:
            packed.append([])
            room = most
        packed[-1].append(path)
        room -= size
    return packed


class Mmcif(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"experiment string, file string, {CHUNK_COLUMNS}"

    def reader(self, schema) -> DataSourceReader:
        return MmcifReader(dict(self.options))


class MmcifReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        options = {name.lower(): value for name, value in options.items()}
        self.path, self.pattern = options["path"], options.get("pattern", "*.cif*")
        self.rows = int(options.get("rows", 10_000))
        self.task_bytes = int(options.get("taskbytes", 128 << 20))
        self.by_block = options.get("namedby", "file") == "block"
        self.categories: frozenset[str] | None = None
        self.experiments: frozenset[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = (f.value,) if isinstance(f, EqualTo) else f.value if isinstance(f, In) else None
            if values is not None and f.attribute == ("category",) and self.categories is None:
                self.categories = frozenset(values)
            elif values is not None and f.attribute == ("experiment",) and self.experiments is None:
                # Files may be left out only where their names say what is in them.
                self.experiments = None if self.by_block else frozenset(values)
                yield f
            else:
                yield f

    def _experiment(self, path: str) -> str:
        return re.sub(r"\.cif(\.gz)?$", "", path.rsplit("/", 1)[-1]).upper()

    def partitions(self) -> list[InputPartition]:
        store, root = open_store(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted(
            (x.path, x.size + FILE_BYTES)
            for x in found
            if x.is_file
            and fnmatch.fnmatch(x.base_name, self.pattern)
            and not re.search(r"(^|/)[._]", x.path.removeprefix(root).lstrip("/"))
            and (self.experiments is None or self._experiment(x.path) in self.experiments)
        )
        return [Files(paths) for paths in pack(files, self.task_bytes)]

    def _chunks(self, store: fs.FileSystem, path: str) -> Iterator[Chunk]:
        with store.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as stream:
            lines = io.TextIOWrapper(stream, "utf-8", errors="replace", newline="\n")
            yield from parse_lines(lines, self.rows, self.categories)

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        store, _ = open_store(self.path)
        held: list[tuple[str, Chunk]] = []
        size = chars = 0

        def batch() -> pa.RecordBatch:
            chunks = [chunk for _, chunk in held]
            names = [(c[0] or "").upper() if self.by_block else self._experiment(path) for path, c in held]
            first = [pa.array(names, pa.string()), pa.array([path for path, _ in held], pa.string())]
            return pa.RecordBatch.from_arrays(first + chunk_columns(chunks), names=["experiment", "file", *CHUNK_NAMES])

        for path in partition.paths:
            for chunk in self._chunks(store, path):
                held.append((path, chunk))
                size += sum(map(len, chunk[3].values()))
                chars += sum(sum(map(len, values)) for values in chunk[3].values())
                if size >= BATCH_VALUES or chars >= BATCH_CHARS:
                    yield batch()
                    held, size, chars = [], 0, 0
        if held:
            yield batch()


def register_mmcif(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach it."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(Mmcif)
