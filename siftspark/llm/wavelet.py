"""Token ids of a corpus as compressed wavelet matrices, one file per shard.

A wavelet matrix keeps a sequence of ids as bit-planes, the highest bit first; behind each plane the
ids are ordered by that plane's bit, zeros first, each half in its former order. A plane is cut into
blocks of 32768 bits that are compressed each for itself; a directory has every block's place and the
number of ones before it. So one id (`access`), the number of an id's occurrences in a range (`count`)
and the place of its k-th occurrence (`select`) each take one or two blocks of every plane, read by range.

Shards follow the order of doc_id: Spark deals the rows by range, tasks encode theirs in order and
close a file after so many ids. A file that an attempt leaves behind without finishing is in no
manifest, so it is never read; a rerun writes under a new name.

Defined results: a NULL text is an empty one, whose only id is the end mark; NULL doc_ids come
first; rows that share a doc_id are kept, in the order of their texts' hashes; an empty table gives no
files and no rows. Only `doc_id` and `text` are read, so other columns can't clash.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftspark.llm.common import open_store, slices, text_of

MAGIC = b"WMTX0001"
HEADER = 5 * 8
BLOCK_BITS = 1 << 15
BLOCK_BYTES = BLOCK_BITS // 8
END_ID = 1
MOST_WORDS = 1 << 20  # that a worker keeps the ids of
BLOCK_TEXT = 16 << 20  # bytes of text that are encoded at once


# Letters that normal form C leaves as they are, and marks that never belong to the word before them.
SIMPLE = "^(?P<letters>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[.,;:!?#*$%&]*)$"


class Pool:
    """Runs of ids by number."""

    def __init__(self):
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])

    def take(self, which: np.ndarray) -> np.ndarray:
        """The runs' ids in a row."""
        starts, sizes = self.starts[which], self.sizes[which]
        ends = np.cumsum(sizes)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class Encoder:
    """Ids of texts, each with the end mark.

    The tokenizer's normaliser and its cut into words never look across white space, so runs of other
    characters are encoded for themselves. A run of plain letters and marks behind them is at most two
    words of the tokenizer, which come again in other runs; words are encoded many at a time, their ids
    end where an id says so, and they are remembered. Other runs are left to the tokenizer as they are,
    and whole texts are if it doesn't lower letters and cut words so.
    """

    def __init__(self, path: str, end: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer, self.end = Tokenizer.from_file(path), end
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.by_words = bool(suffix and normal and cut) and (
            normal.normalize_str("Ab\u00c9\n c") == "ab\u00e9 c"
            and [x for x, _ in cut.pre_tokenize_str("ab.,c 's")] == ["ab", ".,", "c", "'s"]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.numbers, self.words = {"": 0}, Pool()
        self.words.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def _in_rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ASCII words go straight to the model, whose bytes they are; others through the whole tokenizer."""
        plain = np.array([w.isascii() for w in words], bool)
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(w)] for w in words if w.isascii()]
        ids, sizes = [np.array([i for x in found for i in x], np.uint32)], np.zeros(len(words), np.int64)
        sizes[plain] = [len(x) for x in found]
        rest = [w for w in words if not w.isascii()]
        if rest:
            rows = [" ".join(rest[i : i + 1000]) for i in range(0, len(rest), 1000)]
            more, _ = self._alone(rows)
            last = np.flatnonzero(self.ends[more]) + 1
            if len(last) == len(rest) and last[-1] == len(more):
                ids.append(more)
                sizes[~plain] = np.diff(last, prepend=0)
            else:
                more, sizes[~plain] = self._alone(rest)
                ids.append(more)
        both, order = Pool(), np.argsort(np.argsort(~plain, kind="stable"))
        both.add(np.concatenate(ids), sizes[np.argsort(~plain, kind="stable")])
        return both.take(order), sizes

    def _numbers(self, texts: pa.Array, encode: Callable) -> np.ndarray:
        """Numbers of words; `encode` gives the ids of those that are new."""
        coded = texts.dictionary_encode()
        words, numbers = coded.dictionary.to_pylist(), self.numbers
        new = [w for w in words if w not in numbers]
        if new:
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
            self.words.add(*encode(new))
        return np.array([numbers[w] for w in words], np.int64)[coded.indices.to_numpy()]

    def _runs(self, runs: pa.Array) -> Pool:
        """The ids of distinct runs, and behind them the end mark."""
        if len(self.numbers) > MOST_WORDS:
            self.forget()
        parts = pc.extract_regex(runs, SIMPLE)
        simple = parts.is_valid()
        parts, simple, odd = parts.filter(simple), simple.to_numpy(False), runs.filter(pc.invert(simple))
        pairs = np.zeros((len(runs), 2), np.int64)
        letters, marks = (pc.struct_field(parts, name) for name in ("letters", "marks"))
        n = len(parts)
        both = self._numbers(pa.concat_arrays([pc.utf8_lower(letters), marks]), self._in_rows)
        pairs[simple, 0], pairs[simple, 1] = both[:n], both[n:]
        pairs[~simple, 0] = self._numbers(odd, self._alone)
        found = Pool()
        found.add(self.words.take(pairs.ravel()), self.words.sizes[pairs].sum(axis=1))
        found.add(np.array([self.end], np.uint32), np.ones(1, np.int64))
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids end."""
        if not self.by_words:
            ids, sizes = self._alone(texts.to_pylist())
            last = np.cumsum(sizes)
            return np.insert(ids, last, self.end), last + 1 + np.arange(len(last))
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        runs, end = self._runs(coded.dictionary), len(coded.dictionary)
        last = np.cumsum(pc.list_value_length(lists).to_numpy())
        which = np.insert(coded.indices.to_numpy(), last, end)
        return runs.take(which), np.cumsum(runs.sizes[which])[last + np.arange(len(last))]


@lru_cache(1)
def encoder_of(path: str, end: int) -> Encoder:
    """The encoder of a Python worker, which goes on from task to task with the words it remembers."""
    return Encoder(path, end)


def bit_planes(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for bit in range(bits - 1, -1, -1):
        plane = (ids & ids.dtype.type(1 << bit)) != 0
        yield plane
        ids = np.concatenate([ids.take(np.flatnonzero(~plane)), ids.take(np.flatnonzero(plane))])


def to_bytes(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> Iterator[bytes]:
    """The file's parts: header, directory, documents, blocks of the planes in order.

    Header: MAGIC, then numbers of ids, bits and documents and the documents' bytes. Directory: for
    each plane and block the ones before it in the plane, with their total at the end, then for each
    block where it ends in the file. A block as long as it would be raw is raw.
    """
    n, bits = len(ids), max(1, int(ids.max(initial=0)).bit_length())
    blocks, compress = -(-n // BLOCK_BITS), zstandard.ZstdCompressor(level=1).compress
    ones, data = np.zeros((bits, blocks + 1), "<u8"), []
    for p, plane in enumerate(bit_planes(ids.astype(np.uint16 if bits <= 16 else np.uint32), bits)):
        raw = np.packbits(plane, bitorder="little")
        raw = np.concatenate([raw, np.zeros(blocks * BLOCK_BYTES - len(raw), np.uint8)]).reshape(blocks, BLOCK_BYTES)
        ones[p, 1:] = np.cumsum(np.bitwise_count(raw).sum(axis=1, dtype=np.uint64))
        for block in raw:
            block = block.tobytes()
            packed = compress(block)
            data.append(packed if len(packed) < BLOCK_BYTES else block)
    valid = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], "<i8")
    docs = zlib.compress(valid.tobytes() + numbers.tobytes() + np.asarray(ends, "<u8").tobytes(), 1)
    front = HEADER + ones.nbytes + 8 * bits * blocks + len(docs)
    yield MAGIC + np.array([n, bits, len(doc_ids), len(docs)], "<u8").tobytes()
    yield ones.tobytes()
    yield (front + np.cumsum([len(x) for x in data], dtype="<u8")).astype("<u8").tobytes()
    yield docs
    yield from data


class Matrix:
    """One file, through `read(offset, length)`."""

    def __init__(self, read: Callable[[int, int], bytes]):
        head = read(0, HEADER)
        if head[:8] != MAGIC:
            raise ValueError("a wavelet matrix is expected")
        self.n, self.bits, self.n_docs, self._docs = (int(x) for x in np.frombuffer(head[8:], "<u8"))
        self.blocks = -(-self.n // BLOCK_BITS)
        size = 8 * self.bits * (self.blocks + 1)
        self.ones = np.frombuffer(read(HEADER, size), "<u8").astype(np.int64).reshape(self.bits, -1)
        self._read, self._at = read, HEADER + size
        ends = np.frombuffer(read(self._at, 8 * self.bits * self.blocks), "<u8").astype(np.int64)
        self._at += 8 * len(ends)
        self._starts = np.r_[self._at + self._docs, ends]
        self._block = lru_cache(64)(self._load)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """doc_ids, and where the ids of each end."""
        data, n = zlib.decompress(self._read(self._at, self._docs)), self.n_docs
        numbers = np.frombuffer(data, "<i8", n, n)
        ids = [int(x) if ok else None for ok, x in zip(data[:n], numbers)]
        return ids, np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64)

    def _unpack(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data if len(data) == BLOCK_BYTES else zstandard.decompress(data), np.uint8)

    def _load(self, plane: int, block: int) -> np.ndarray:
        k = plane * self.blocks + block
        return self._unpack(self._read(int(self._starts[k]), int(self._starts[k + 1] - self._starts[k])))

    def _rank(self, plane: int, i: int) -> int:
        """Ones before place i."""
        block, rest = divmod(i, BLOCK_BITS)
        before = int(self.ones[plane, block])
        if not rest:
            return before
        bits = np.unpackbits(self._block(plane, block)[: -(-rest // 8)], bitorder="little")
        return before + int(bits[:rest].sum())

    def _select(self, plane: int, k: int, bit: int) -> int:
        """The place of the k-th (from 0) one or zero; it must exist."""
        before = self.ones[plane] if bit else np.arange(self.blocks + 1) * BLOCK_BITS - self.ones[plane]
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self._block(plane, block), bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def _zeros(self, plane: int) -> int:
        return self.n - int(self.ones[plane, -1])

    def _bit(self, plane: int, i: int) -> int:
        block, rest = divmod(i, BLOCK_BITS)
        return int(self._block(plane, block)[rest >> 3] >> (rest & 7) & 1)

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            bit, ones = self._bit(plane, i), self._rank(plane, i)
            value, i = value << 1 | bit, self._zeros(plane) + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where behind the last plane the occurrences of the id between lo and hi lie."""
        if token < 0 or token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            a, b = self._rank(plane, lo), self._rank(plane, hi)
            if token >> (self.bits - 1 - plane) & 1:
                lo, hi = self._zeros(plane) + a, self._zeros(plane) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of the id from place lo to before place hi."""
        hi = self.n if hi is None else min(hi, self.n)
        a, b = self._range(token, min(lo, hi), hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of the id."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._select(plane, at - (self._zeros(plane) if bit else 0), bit)
        return at

    def ids(self) -> np.ndarray:
        """All ids, from the last plane back to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        low = np.zeros(self.n, kind)
        for plane in range(self.bits - 1, -1, -1):
            at = self._starts[plane * self.blocks : (plane + 1) * self.blocks + 1]
            data = self._read(int(at[0]), int(at[-1] - at[0]))
            cuts = (at - at[0]).tolist()
            raw = [self._unpack(data[a:b]) for a, b in zip(cuts, cuts[1:])]
            raw = np.concatenate(raw) if raw else np.zeros(0, np.uint8)
            ones = np.unpackbits(raw, count=self.n, bitorder="little").astype(bool)
            zeros, ids = self._zeros(plane), np.empty(self.n, kind)
            ids[np.flatnonzero(~ones)] = low[:zeros]
            ids[np.flatnonzero(ones)] = low[zeros:] | kind(1 << (self.bits - 1 - plane))
            low = ids
        return low


def by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with about BLOCK_TEXT bytes of text or a single row."""
    for batch in slices(batches, 10_000):
        block = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64) // BLOCK_TEXT
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=np.iinfo(np.int64).max)) if len(block) else []
        for at, end in zip(cuts, cuts[1:]):
            yield batch.slice(at, end - at)


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, shard_ids: int = 1 << 22, end: int = END_ID
) -> DataFrame:
    """path, part, place, docs, ids of the files written: ordered by part and place they follow doc_id.

    `tokenizer` is the path of a file of the tokenizers library.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, made = encoder_of(tokenizer, end), TaskContext.get().partitionId(), []
        doc_ids, ids, ends, size = [], [], [], 0

        def close() -> None:
            store, root = open_store(folder)
            store.create_dir(root, recursive=True)
            name = f"{uuid.uuid4().hex}.wm"
            with store.open_output_stream(f"{root}/{name}") as out:
                for piece in to_bytes(np.concatenate(ids), doc_ids, np.concatenate(ends)):
                    out.write(piece)
            made.append(
                {"path": f"{folder}/{name}", "part": part, "place": len(made), "docs": len(doc_ids), "ids": size}
            )

        for batch in by_bytes(batches):
            found, stops = encoder(batch["text"])
            doc_ids += batch["doc_id"].to_pylist()
            ids.append(found)
            ends.append(stops + size)
            size += len(found)
            if size >= shard_ids:
                close()
                doc_ids, ids, ends, size = [], [], [], 0
        if doc_ids:
            close()
        if made:
            yield pa.RecordBatch.from_pylist(made)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # About four bytes of text make an id.
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // (4 * shard_ids)))
    order = ["doc_id", "_tie"]
    dealt = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "text").mapInArrow(write, "path string, part long, place long, docs long, ids long")


def with_starts(shards: DataFrame) -> DataFrame:
    """The shards with `start`, the number of ids in all shards before; one row for each file."""
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))


def open_matrix(path: str) -> Matrix:
    store, name = open_store(path)
    file = store.open_input_file(name)

    def read(offset: int, length: int) -> bytes:
        file.seek(offset)
        return file.read(length)

    return Matrix(read)


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files of shards with `start`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
                matrix = open_matrix(path)
                doc_ids, ends = matrix.documents()
                data, starts = matrix.ids().astype("<u4").data.cast("B"), np.r_[0, ends][:-1]
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "start": pa.array(starts + start, pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    shards = shards.select("path", "start")
    dealt = shards.repartition(max(1, shards.count()))
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
