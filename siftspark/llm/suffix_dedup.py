"""Exact removal of byte strings that a document with a smaller id has too, by suffix sorting.

A string of `span` bytes is removed from a document if it also starts in one with a smaller id.
No machine can hold the suffixes of the corpus, so they are dealt to shards by content: of the grams in
each string of `span` bytes one has the smallest hash, equal strings agree on it, and the strings
around one gram form one short piece. Two rounds follow. First only the grams' keys travel,
and a gram that one document alone has is out: its strings can't be anywhere else. Then pieces of
the other grams travel. Equal pieces are one, kept for its smallest id, whose copies lose
all of it, so a group of copies of any size costs its pieces once. What is left of a shard is
one text; its suffixes are sorted by induction (`induced`), neighbours with `span` bytes in
common form groups, and within a group every document but the smallest loses the string.
A gram whose distinct pieces are more than a shard is not sorted: its strings are grouped as rows.

Documents equal to one with a smaller id are settled before all this and take no part in it.

Defined results: NULL texts are empty; texts under `span` bytes lose nothing; rows of one id take
nothing from each other, and different texts under one id are told apart; rows with a NULL id lose nothing and take nothing; an
empty table gives no rows. Texts are bytes: a removed run may end inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import slices, staged, text_of
from siftspark.llm.induced import sort_suffixes
from siftspark.llm.jaccard import pack, unpack
from siftspark.operators.scope import broadcast_if_small

GRAM = 24
CHUNK = 1 << 20  # bytes looked at together
BLOCK = 1 << 14  # bytes hashed at once, so that the arrays stay in a core's cache
PLACE_BITS = np.uint64(24)
PLACE_MASK = np.uint64((1 << 24) - 1)
BASE = np.uint64(0x9E3779B185EBCA87)
FINAL = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each gram, by doubling; one for each place where a whole gram starts."""
    total, reach, power = None, 0, BASE
    part, size = (data.astype(np.uint64) + np.uint64(1)) * FINAL, 1
    rest = gram
    while rest:
        if rest & 1:
            if total is None:
                total = part
            else:
                ahead = part[reach:]
                total = total[: len(ahead)] * pow_of(size) + ahead
            reach += size
        rest >>= 1
        if rest:
            ahead = part[size:]
            part = part[: len(ahead)] * power
            part += ahead
            power = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
            size *= 2
    total ^= total >> np.uint64(31)
    total *= FINAL
    return total


def pow_of(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def runs(texts: list[bytes], span: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, start, end, key): strings of `span` bytes from start to end share a gram.

    `start` and `end` are the first and last such string's places in the text. Texts are
    looked at in chunks; those longer than a chunk, in chunks that overlap by a string.
    """
    pieces, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(len(text) - span + 1, 0), CHUNK):
            part = text[at : at + CHUNK + span - 1]
            pieces.append((number, at, part))
            size += len(part)
            if size >= CHUNK:
                yield _runs_of(pieces, span, gram)
                pieces, size = [], 0
    if pieces:
        yield _runs_of(pieces, span, gram)


def _least_grams(data: np.ndarray, span: int, gram: int, at: int) -> np.ndarray:
    """The least hash of each string's grams, with the gram's place (counted from `at`) in its low bits."""
    least = gram_hashes(data, gram)
    least &= ~PLACE_MASK
    least |= np.arange(at, at + len(least), dtype=np.uint64)
    reach, want = 1, span - gram + 1
    while reach < want:
        step = min(reach, want - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def _runs_of(pieces: list[tuple[int, int, bytes]], span: int, gram: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    lengths = np.array([len(p[2]) for p in pieces])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    n = len(data)
    # Grams that cross a text's end are in no valid string.
    least = np.zeros(n, np.uint64)
    for at in range(0, n - span + 1, BLOCK):
        found = _least_grams(data[at : at + BLOCK + span - 1], span, gram, at)
        least[at : at + len(found)] = found
    piece = np.repeat(np.arange(len(pieces)), lengths)
    inside = np.arange(n) - starts[piece]
    valid = inside <= lengths[piece] - span
    where = np.flatnonzero(valid)
    if not len(where):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    mark = least[where]
    first = np.r_[True, (mark[1:] != mark[:-1]) | (piece[where][1:] != piece[where][:-1])]
    at = np.flatnonzero(first)
    last = np.r_[at[1:] - 1, len(where) - 1]
    numbers = np.array([p[0] for p in pieces])[piece[where[at]]]
    offsets = np.array([p[1] for p in pieces])[piece[where[at]]]
    return (
        numbers,
        offsets + inside[where[at]],
        offsets + inside[where[last]],
        mark[at] >> PLACE_BITS,
    )


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.to_pylist()]


def shared_grams(texts: DataFrame, span: int, gram: int, buckets: int) -> DataFrame:
    """doc_id, keys: the grams of a document that another document has too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = np.array(batch["doc_id"].to_pylist(), np.int64)
            for number, _, _, key in runs(_bytes_of(batch["data"]), span, gram):
                if not len(key):
                    continue
                docs = ids[number]
                where = (key % np.uint64(buckets)).astype(np.int64)
                by = np.lexsort((key, docs, where))
                docs, key, where = docs[by], key[by], where[by]
                once = np.r_[True, (docs[1:] != docs[:-1]) | (key[1:] != key[:-1])]
                docs, key, where = docs[once], key[once], where[once]
                own, index = np.unique(docs, return_inverse=True)
                index = index.astype(np.uint32)
                ends = np.searchsorted(where, np.arange(buckets + 1))
                used = [b for b in range(buckets) if ends[b] < ends[b + 1]]
                rows = {"bucket": used, "keys": [], "index": [], "docs": []}
                for b in used:
                    part = index[ends[b] : ends[b + 1]]
                    there, part = np.unique(part, return_inverse=True)
                    rows["keys"].append(pack(key[ends[b] : ends[b + 1]]))
                    rows["index"].append(part.astype(np.uint16 if len(there) < 1 << 16 else np.uint32).tobytes())
                    rows["docs"].append(own[there].tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(rows["bucket"], pa.int64()),
                        "keys": pa.array(rows["keys"], pa.binary()),
                        "index": pa.array(rows["index"], pa.binary()),
                        "docs": pa.array(rows["docs"], pa.binary()),
                    }
                )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        keys, docs = [], []
        for key, index, doc in zip(rows["keys"], rows["index"], rows["docs"]):
            key = unpack(key)
            kind = np.uint16 if len(index) == 2 * len(key) else np.uint32
            keys.append(key)
            docs.append(np.frombuffer(doc, np.int64)[np.frombuffer(index, kind)])
        keys, docs = np.concatenate(keys), np.concatenate(docs)
        by = np.lexsort((docs, keys))
        keys, docs = keys[by], docs[by]
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        end = np.r_[start[1:], len(keys)]
        several = docs[start] != docs[end - 1]
        kept = np.repeat(several, end - start)
        keys, docs = keys[kept], docs[kept]
        part = (docs.astype(np.uint64) * FINAL >> np.uint64(33)).astype(np.int64) % buckets
        by = np.lexsort((docs, part))
        keys, docs, part = keys[by], docs[by], part[by]
        ends = np.searchsorted(part, np.arange(buckets + 1))
        used = [p for p in range(buckets) if ends[p] < ends[p + 1]]
        return pd.DataFrame(
            {
                "part": pd.Series(used, dtype=np.int64),
                "docs": [docs[ends[p] : ends[p + 1]].tobytes() for p in used],
                "keys": [pack(keys[ends[p] : ends[p + 1]]) for p in used],
            }
        )

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        docs, keys = np.frombuffer(b"".join(rows["docs"]), np.int64), unpack(b"".join(rows["keys"]))
        by = np.lexsort((keys, docs))
        docs, keys = docs[by], keys[by]
        start = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        end = [*start[1:], len(docs)]
        found = [pack(keys[a:b]) for a, b in zip(start, end)]
        return pd.DataFrame({"doc_id": docs[start], "keys": found})

    sent = texts.mapInArrow(send, "bucket long, keys binary, index binary, docs binary")
    met = sent.groupBy("bucket").applyInPandas(meet, "part long, docs binary, keys binary")
    return met.groupBy("part").applyInPandas(gather, "doc_id long, keys binary")


def pieces_of(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """key, piece, name, doc_id, twin, start: the stretches around shared grams.

    Takes doc_id, twin, data and `shared`, the document's shared keys.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts_ = batch["doc_id"].to_pylist(), _bytes_of(batch["data"])
            twins = batch["twin"].to_pylist()
            wanted = [
                np.uint64(i) << np.uint64(40) | unpack(keys)
                for i, keys in enumerate(batch["shared"].to_pylist())
            ]
            wanted = np.sort(np.concatenate(wanted)) if wanted else np.zeros(0, np.uint64)
            for number, start, end, key in runs(texts_, span, gram):
                if not len(key):
                    continue
                asked = number.astype(np.uint64) << np.uint64(40) | key
                at = np.minimum(np.searchsorted(wanted, asked), len(wanted) - 1)
                hit = np.flatnonzero(wanted[at] == asked)
                parts = [texts_[number[i]][start[i] : end[i] + span] for i in hit]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(key[hit].astype(np.int64), pa.int64()),
                        "piece": pa.array(parts, pa.binary()),
                        "name": pa.array([xxhash.xxh3_128_digest(p) for p in parts], pa.binary()),
                        "doc_id": pa.array([ids[i] for i in number[hit]], pa.int64()),
                        "twin": pa.array([twins[i] for i in number[hit]], pa.int64()),
                        "start": pa.array(start[hit], pa.int64()),
                    }
                )

    return texts.mapInArrow(cut, "key long, piece binary, name binary, doc_id long, twin long, start long")


def sorted_shards(distinct: DataFrame, span: int, shards: int, memory: int) -> DataFrame:
    """name, offset, length: what a piece's smallest holder loses to smaller documents.

    `distinct` has one row per piece: name, key, piece, first. Pieces of a key meet in a shard.
    """

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["piece"].map(len).to_numpy()
        data = np.frombuffer(b"\0".join(rows["piece"]) + b"\0" * 8, np.uint8)
        begin = np.r_[0, np.cumsum(lengths + 1)[:-1]]
        symbols = data[:-7].astype(np.uint16) + np.uint16(2)
        symbols[begin + lengths] = 1
        symbols[-1] = 0
        owner = np.repeat(np.arange(len(rows)), lengths + 1)
        inside = np.arange(len(owner)) - begin[owner]
        whole = inside <= lengths[owner] - span
        order = sort_suffixes(symbols, span, memory)
        order = order[whole[order]]
        # Neighbours in order: their common prefix is followed for `span` bytes, eight at a time.
        words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
        joined = np.zeros(len(order), bool)
        left = np.arange(1, len(order))
        for k in [*range(0, span - 8, 8), span - 8]:
            a, b = words[order[left - 1] + k], words[order[left] + k]
            a, b = (np.ascontiguousarray(x).view("<u8").ravel() for x in (a, b))
            left = left[a == b]
        joined[left] = True
        start = np.flatnonzero(~joined)
        docs = rows["first"].to_numpy()[owner[order]]
        least = np.repeat(np.minimum.reduceat(docs, start), np.diff(np.r_[start, len(docs)]))
        lost = np.sort(order[docs > least])
        new = np.r_[True, (np.diff(lost) > 1) | (np.diff(owner[lost]) != 0)][: len(lost)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(lost)].astype(np.int64)[: len(first)] - 1
        return pd.DataFrame(
            {
                "name": rows["name"].to_numpy()[owner[lost[first]]],
                "offset": inside[lost[first]],
                "length": lost[last] - lost[first] + span,
            }
        )

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(sort, "name binary, offset long, length long")


def grouped_strings(distinct: DataFrame, span: int) -> DataFrame:
    """What `sorted_shards` gives, one row per lost string, found without sorting a shard.

    Each string of the pieces is a row, at most span - gram + 1 of a piece, and Spark's
    aggregate and join bring equal ones together: they need no task to hold a gram's pieces.
    """
    offsets = F.sequence(F.lit(0), F.octet_length("piece") - span)
    strings = distinct.select("name", "first", "piece", F.explode(offsets).alias("offset")).select(
        "name",
        "first",
        F.col("offset").cast("long").alias("offset"),
        F.substr("piece", F.col("offset") + 1, F.lit(span)).alias("string"),
    )
    least = strings.groupBy(F.col("string").alias("_string")).agg(
        F.min("first").alias("_least"), F.max("first").alias("_most")
    )
    least = staged(least.filter("_least < _most").drop("_most"), "repeated-strings")
    lost = strings.join(least, F.col("string") == F.col("_string")).filter("first > _least")
    return lost.select("name", "offset", F.lit(span).cast("long").alias("length"))


def lost_ranges(distinct: DataFrame, span: int, shard_bytes: int, memory: int) -> DataFrame:
    """name, offset, length: pieces in sorted shards, those of a gram too large for one as strings."""
    grams = distinct.groupBy(F.col("key").alias("_key")).agg(
        F.sum(F.octet_length("piece")).alias("_bytes")
    )
    grams = staged(grams, "gram-sizes")
    large = grams.filter(F.col("_bytes") > shard_bytes).select("_key")
    size = grams.filter(F.col("_bytes") <= shard_bytes).agg(F.sum("_bytes")).first()[0] or 0
    shards = int(max(8, size // shard_bytes))
    if large.isEmpty():
        return sorted_shards(distinct, span, shards, memory)
    large = broadcast_if_small(large)
    same = F.col("key") == F.col("_key")
    own = sorted_shards(distinct.join(large, same, "left_anti"), span, shards, memory)
    return own.unionByName(grouped_strings(distinct.join(large, same, "left_semi"), span))


def repeated_spans(docs: DataFrame, span: int, gram: int, shard_bytes: int, memory: int) -> DataFrame:
    """doc_id, twin, spans: where documents lose bytes, as (start, length) pairs that may overlap."""
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "twin", "data")
    texts = texts.filter(F.octet_length("data") >= span)
    total = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = int(max(8, total // (16 << 20)))
    shared = shared_grams(texts, span, gram, buckets).toDF("_id", "shared")
    shared = staged(shared, "shared-grams")
    wanted = texts.join(shared, F.col("doc_id") == F.col("_id"))
    pieces = staged(pieces_of(wanted.select("doc_id", "twin", "data", "shared"), span, gram), "pieces")

    names = pieces.groupBy("name").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("most"), F.min("key").alias("key")
    )
    names = staged(names, "piece-names")
    # Only where a gram has different pieces can a string be in two of them.
    several = names.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    unsure = names.join(several, F.col("key") == F.col("_key")).select(
        F.col("name").alias("_name"), "first"
    )
    distinct = (
        pieces.join(unsure, (F.col("name") == F.col("_name")) & (F.col("doc_id") == F.col("first")))
        .groupBy("name", "key", "first")
        .agg(F.first("piece").alias("piece"))
    )
    distinct = staged(distinct, "distinct-pieces")
    own = lost_ranges(distinct, span, shard_bytes, memory)
    lost = own.groupBy(F.col("name").alias("_own")).agg(
        F.collect_list(F.struct("offset", "length")).alias("_ranges")
    )
    verdicts = names.join(lost, F.col("name") == F.col("_own"), "left").filter(
        "first < most OR _ranges IS NOT NULL"
    )
    # Written down, so that the join below shuffles both sides and AQE can split hot pieces.
    verdicts = staged(verdicts.select(F.col("name").alias("_name"), "first", "_ranges"), "verdicts")
    held = pieces.select(
        "name", "doc_id", "twin", "start", F.octet_length("piece").cast("long").alias("length")
    )
    whole = F.array(F.struct(F.lit(0).cast("long").alias("offset"), "length"))
    ranges = F.when(F.col("doc_id") > F.col("first"), whole).otherwise(F.col("_ranges"))
    return (
        held.join(verdicts, F.col("name") == F.col("_name"))
        .select("doc_id", "twin", "start", F.explode(ranges).alias("_r"))
        .groupBy("doc_id", "twin")
        .agg(
            F.collect_list(
                F.struct((F.col("start") + F.col("_r.offset")).alias("start"), F.col("_r.length"))
            ).alias("spans")
        )
    )


def remove_repeats(
    docs: DataFrame,
    span: int = 50,
    gram: int = GRAM,
    shard_bytes: int = 2 << 20,
    memory: int = 128 << 20,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: one row per document, `kept` as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc, data, copy, spans in zip(*(batch[c].to_pylist() for c in ("doc_id", "data", "copy", "spans"))):
                n = len(data)
                if copy and n >= span:
                    rows.append((doc, n, n, 1, b""))
                    continue
                kept, end, removed, count = [], 0, 0, 0
                for start, length in sorted((s["start"], s["length"]) for s in spans or []):
                    if start > end or count == 0:
                        kept.append(data[end:start])
                        count += 1
                        removed += length
                        end = start + length
                    elif start + length > end:
                        removed += start + length - end
                        end = start + length
                kept.append(data[end:])
                rows.append((doc, n, removed, count, b"".join(kept)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("data"))
    marked = rows.withColumn("_sha", F.sha2("data", 256))
    # Written down, so that whole texts are read once for both lists.
    digests = staged(marked.filter("doc_id IS NOT NULL").select("doc_id", "_sha"), "digests")
    least = digests.groupBy("_sha").agg(
        F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most")
    )
    least = broadcast_if_small(staged(least.filter("_least < _most").drop("_most"), "equal-texts"))
    copy = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    marked = marked.join(least, "_sha", "left").withColumn("copy", copy)
    # `twin` is 0, but where an id has several texts: there it is the text's hash.
    several = digests.groupBy(F.col("doc_id").alias("_twins")).agg(F.min("_sha").alias("_a"), F.max("_sha").alias("_b"))
    several = broadcast_if_small(staged(several.filter("_a < _b").select("_twins"), "twins"))
    twin = F.when(F.col("_twins").isNotNull(), F.xxhash64("_sha")).otherwise(F.lit(0).cast("long"))
    marked = marked.join(several, F.col("doc_id") == F.col("_twins"), "left").withColumn("twin", twin)
    marked = marked.select("doc_id", "twin", "copy", "data")
    spans = repeated_spans(marked.filter("NOT copy"), span, gram, shard_bytes, memory)
    spans = staged(spans.withColumnsRenamed({"doc_id": "_id", "twin": "_twin"}), "spans")
    return (
        marked.join(spans, (F.col("doc_id") == F.col("_id")) & (F.col("twin") == F.col("_twin")), "left")
        .select("doc_id", "data", "copy", "spans")
        .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
