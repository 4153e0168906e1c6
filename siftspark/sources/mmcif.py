"""mmCIF text to documents.

The text source delivers one row per file (unzipping `.gz`), Spark spreads the files over
tasks, and each Arrow batch of texts is tokenised in a Python worker. A file is the unit
of work because its quoting and loop state run from its first line to its last; Arrow
batches are parsed in slices of a bounded size, so what a worker holds beside one does not grow with it.
"""

from __future__ import annotations

import io
import json
import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.operators.keys import distinct_keys
from siftspark.operators.reshape import ragged

# Workers get this module's functions with the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What is parsed together takes several times its size in Python.
PARSED_BYTES = 1 << 20

DATA_TYPE = "map<string,map<string,variant>>"

# Every token that is no plain value starts with one of the first four characters, or is a
# reserved word, which has an underscore in a known place.
_MARK = re.compile("""['"#;_]""")
_RESERVED = {"loop": True, "stop": True, "global": True, "data": False, "save": False}
_QUOTED = {"'": re.compile(r"'(.*?)'(?=\s|$)"), '"': re.compile(r'"(.*?)"(?=\s|$)')}
_WORD = re.compile(r"\S+")


def _word_start(text: str, underscore: int) -> int:
    """Where the item name or reserved word with this underscore starts; -1 for neither."""
    if text[underscore - 1].isspace():
        return underscore
    for size in (4, 6):
        start = underscore - size
        if start > 0 and text[start - 1].isspace():
            whole = _RESERVED.get(text[start:underscore].lower())
            if whole is not None and (not whole or not text[underscore + 1 : underscore + 2].strip()):
                return start
    return -1


def _tokens(text: str) -> Iterator[tuple[bool, list[str]]]:
    """Tokens in order, as (is it a name or keyword, tokens); values come in runs.

    Between marks the text is split at white space in one go, so the long numeric tables
    that make up most of an archive cost little Python per value.
    """
    text = "\n" + text.replace("\r\n", "\n")
    at = look = 0  # start of the open run, place to look for the next mark
    while mark := _MARK.search(text, look):
        start = mark.start()
        first = text[start]
        if first == "_":
            start = _word_start(text, start)
        elif not text[start - 1].isspace() or (first == ";" and text[start - 1] != "\n"):
            start = -1
        if start < 0:
            look = mark.end()
            continue
        values = text[at:start].split()
        if values:
            yield False, values
        if first == ";":  # text field, up to the next line that starts with ';'
            at = text.find("\n;", start)
            if at < 0:
                yield False, [text[start + 1 :]]
                return
            yield False, [text[start + 1 : at]]
            at += 2
        elif first == "#":  # comment
            at = text.find("\n", start)
            if at < 0:
                return
        elif quoted := first in _QUOTED and _QUOTED[first].match(text, start):
            yield False, [quoted[1]]
            at = quoted.end()
        else:  # also a quote that is never closed
            word = _WORD.match(text, start)
            yield first not in _QUOTED, [word[0]]
            at = word.end()
        look = at
    values = text[at:].split()
    if values:
        yield False, values


def parse_text(
    text: str, categories: frozenset[str] | None = None
) -> tuple[str | None, dict[str, dict]]:
    """First data block of a text: its name and {category: {attribute: value or values}}.

    With categories (without underscore) only these are kept.
    """
    name, block = None, {}
    loop: list[str] | None = None  # item names of the open loop
    values: list[str] = []
    item: str | None = None

    def put(full: str, value) -> None:
        cat, _, attribute = full.partition(".")
        if categories is None or cat.removeprefix("_") in categories:
            block.setdefault(cat, {})[attribute] = value

    def close() -> None:
        nonlocal loop, values
        for i, full in enumerate(loop or ()):
            put(full, values[i :: len(loop)])
        loop, values = None, []

    for special, words in _tokens(text):
        if not special:
            if loop:
                values.extend(words)
            elif item is not None:
                put(item, words[0])
                item = None
            continue
        word = words[0]
        lower = word.lower()
        if word[0] == "_":
            if loop is None or values:
                close()
                item = word
            else:
                loop.append(word)
        elif lower == "loop_":
            close()
            loop, item = [], None
        elif lower.startswith("data_"):
            close()
            if name is not None:
                return name, block
            name, item = word[5:], None
    close()
    return name, block


def _pieces(lines: Iterable[str], size: int) -> Iterator[str]:
    """Lines joined to pieces of about `size` characters, none of which ends inside a text field.

    No other token goes on over a line's end, so the tokens of the pieces are those of the text.
    """
    held, length, inside = [], 0, False
    for line in lines:
        inside ^= line.startswith(";")
        held.append(line)
        length += len(line)
        if length >= size and not inside:
            yield "".join(held)
            held, length = [], 0
    if held:
        yield "".join(held)


Chunk = tuple[str | None, str, int, dict[str, list[str]]]


def parse_lines(
    lines: Iterable[str],
    rows: int = 10_000,
    categories: frozenset[str] | None = None,
    size: int = 1 << 20,
) -> Iterator[Chunk]:
    """First data block of lines as (block, category, number of its first row, attributes) in chunks.

    A loop comes in chunks of at most `rows` rows, so neither a text nor a table need fit in memory:
    what is held is a piece of `size` characters, one chunk, and the single values of the block,
    which come last, a row per category. Only the last chunk of a loop can be uneven.
    """
    name: str | None = None
    single: dict[str, dict[str, list[str]]] = {}
    loop: list[str] | None = None
    values: list[str] = []
    begun, first = False, 0  # has the open loop values, and how many of its rows are out
    item: str | None = None

    def wanted(full: str) -> bool:
        return categories is None or full.partition(".")[0].removeprefix("_") in categories

    def put_out(cells: list[str]) -> Iterator[Chunk]:
        found: dict[str, dict[str, list[str]]] = {}
        for i, full in enumerate(loop):
            if wanted(full):
                category, _, attribute = full.partition(".")
                found.setdefault(category, {})[attribute] = cells[i :: len(loop)]
        for category, attributes in found.items():
            yield name, category, first, attributes

    def full_chunks() -> Iterator[Chunk]:
        nonlocal values, first
        cells, at = rows * len(loop), 0
        while len(values) - at >= cells:
            yield from put_out(values[at : at + cells])
            at, first = at + cells, first + rows
        values = values[at:]

    def close() -> Iterator[Chunk]:
        nonlocal loop, values, begun, first
        if loop and (values or not first):
            yield from put_out(values)
        loop, values, begun, first = None, [], False, 0

    def tokens() -> Iterator[tuple[bool, list[str]]]:
        for piece in _pieces(lines, size):
            yield from _tokens(piece)

    for special, words in tokens():
        if not special:
            if loop:
                begun = True
                if any(map(wanted, loop)):
                    values.extend(words)
                    yield from full_chunks()
            elif item is not None:
                if wanted(item):
                    category, _, attribute = item.partition(".")
                    single.setdefault(category, {})[attribute] = [words[0]]
                item = None
            continue
        word = words[0]
        lower = word.lower()
        if word[0] == "_":
            if loop is None or begun:
                yield from close()
                item = word
            else:
                loop.append(word)
        elif lower == "loop_":
            yield from close()
            loop, item = [], None
        elif lower.startswith("data_"):
            yield from close()
            if name is not None:
                break
            name, item = word[5:], None
    yield from close()
    for category, attributes in single.items():
        yield name, category, 0, attributes


def text_problem(text: Column) -> Column:
    """Why a text can't be taken, NULL if it can: it is empty, or it ends inside a text field.

    Lines that begin with a semicolon open and close text fields in turn, so their number is even.
    """
    marks = F.regexp_count(text, F.lit(r"(?m)^;"))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit("empty text")).when(
        marks % 2 == 1, F.lit("text field not closed")
    )


def _few_rows(batch: pa.RecordBatch, text: str, size: int = PARSED_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about `size` bytes, or a single row."""
    lengths = pc.fill_null(pc.binary_length(batch[text]), 0).to_pylist()
    start = held = 0
    for i, length in enumerate(lengths):
        if held and held + length > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += length
    if start < len(lengths):
        yield batch.slice(start)


def parse_mmcif(
    texts: DataFrame,
    text: str = "text",
    as_json: bool = False,
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """Add `block` (name of the first data block) and `data` to rows that carry a text.

    The other columns are kept; the text is not. `data` is a map category -> attribute ->
    leaf, or with `as_json` its JSON text, which `write_raw` puts into documents as it is.
    Categories that are not named, if any are, do not leave the Python worker.
    """
    wanted = None if categories is None else frozenset(categories)
    kept = [f.name for f in texts.schema.fields if f.name != text]
    schema = T.StructType([texts.schema[name] for name in kept]).add("block", "string").add("data", "string")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in _few_rows(batch, text):
                names, blocks = [], []
                for cell in few[text]:
                    name, block = parse_text(cell.as_py(), wanted) if cell.is_valid else (None, {})
                    names.append(name)
                    blocks.append(json.dumps(block, ensure_ascii=False))
                columns = few.select(kept).columns + [pa.array(names, pa.string()), pa.array(blocks, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "block", "data"])
        # A Python worker lives on after its task: what Arrow kept for reuse is given back.
        pa.default_memory_pool().release_unused()

    parsed = texts.mapInArrow(parse, schema)
    return parsed if as_json else parsed.withColumn("data", F.from_json("data", DATA_TYPE))


CHUNK_COLUMNS = "block string, category string, first_row long, attributes map<string,array<string>>"


def parse_mmcif_chunks(
    texts: DataFrame,
    text: str = "text",
    rows: int = 10_000,
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """Rows that carry a text, once for each chunk of up to `rows` rows of each of its categories.

    `category` has no leading underscore. The other columns are kept, the text is not.
    """
    wanted = None if categories is None else frozenset(categories)
    kept = [f.name for f in texts.schema.fields if f.name != text]
    schema = T.StructType([texts.schema[name] for name in kept] + T.StructType.fromDDL(CHUNK_COLUMNS).fields)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others, cells = batch.select(kept), batch[text]
            for i in range(batch.num_rows):
                for chunk in parse_lines(io.StringIO(cells[i].as_py() or "", newline="\n"), rows, wanted):
                    columns = [c.slice(i, 1) for c in others.columns] + chunk_columns([chunk])
                    yield pa.RecordBatch.from_arrays(columns, names=kept + CHUNK_NAMES)

    return texts.mapInArrow(parse, schema)


CHUNK_NAMES = ["block", "category", "first_row", "attributes"]


def chunk_columns(chunks: list[Chunk]) -> list[pa.Array]:
    """The chunks as Arrow columns."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.list_(pa.string()))]
    cells = [
        [c[0] for c in chunks],
        [c[1].removeprefix("_") for c in chunks],
        [c[2] for c in chunks],
        [list(c[3].items()) for c in chunks],
    ]
    return [pa.array(x, kind) for x, kind in zip(cells, kinds)]


def even_chunks(chunks: DataFrame, keys: Iterable[str] = ("experiment",)) -> DataFrame:
    """The chunks of tables none of whose chunks is uneven; a loop cut off shows in its last one.

    Only the keys of uneven tables are shuffled or sent to the tasks.
    """
    keys = [*keys, "category"]
    uneven = distinct_keys(chunks.filter(ragged(F.col("attributes"))).select(*keys))
    return chunks.join(uneven, keys, "left_anti")


def read_mmcif(
    spark: SparkSession,
    path: str,
    pattern: str = "*.cif*",
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """Every matching file below the path as (experiment, block, data)."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.cif(\.gz)?$", "")
    texts = files.select(F.upper(stem).alias("experiment"), F.col("value").alias("text"))
    return parse_mmcif(texts, categories=categories)


__all__ = [
    "DATA_TYPE",
    "chunk_columns",
    "even_chunks",
    "parse_lines",
    "parse_mmcif",
    "parse_mmcif_chunks",
    "parse_text",
    "read_mmcif",
    "text_problem",
]
