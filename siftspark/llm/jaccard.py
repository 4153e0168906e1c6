"""Exact near-duplicate components by a metric-space join under Jaccard distance.

Distances between unrelated texts are all 1, so document pivots alone would leave one region
with everything in it. The first pivots are therefore single shingles: a document lies in the
regions of its rarest shingles, as many of them as guarantee that two documents at distance 0.2 or
less meet in one (a document within 0.2 lacks at most a fifth of the shingles, so it can't miss
that many). Inside a region documents share text and distances tell something. There a central document is
the first pivot: the others' exact distances to it are computed, and those within 0.2 join its
component. What is left in two components goes on to the next round with another pivot.

Regions that these rounds leave open are cut into Voronoi cells, and cells that still hold too many
pairs are cut again with new pivots. Pivots are members of the cell, chosen by hash, the more the
larger the cell is; every member's exact distance to each of them is computed. Its home is the cell of
its nearest pivot. It is copied into the cell of another pivot if a link could cross the border: only
if that pivot is at most 0.4 further away than its own (a link of 0.2 changes both distances by 0.2 at
most), and within 0.2 of the distances that the cell's own members have. So of two linked documents
each is met in the other's home cell, and pairs are compared only there: in one cell, one of them at
home, their distances to its pivot differing by at most 0.2. A cut that would not save a quarter of
the pairs, or more than double the members, is not made: that cell's pairs are compared as they are.
Regions and cells in one component are done. Members meet by bands of their sets' sizes: a member's size
and the place of the region's shingle say how large a set it can be linked with. What is left of a cell's pairs
then decides whether it is cut, and pivots are chosen by hash of the id alone, so cells that overlap share them.

Only an ordering of shingles is shared by all tasks, found over all documents: counts of the most
frequent ones, and of all others that occur a few times a bitmap of their hashes, at most 32 MB.
Any order that all tasks share gives the same links; a full bitmap only costs candidates.

Defined results: texts without words have no shingles, link to nothing and are their own component;
one to four words make one shingle; equal sets are one class, its smallest id stands for it, also
for rows repeated whole; a NULL id is smaller than none and joins no component but its class's; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import slices, staged
from siftspark.llm.components import NEAR_BYTES, components
from siftspark.operators.scope import broadcast_if_small

WORDS = 5
PRIME = np.uint64(0x9E3779B185EBCA87)
FINAL = np.uint64(0xC2B2AE3D27D4EB4F)
KEY_BYTES = 5  # of a shingle's hash, where it only orders and meets
COUNTED = 64  # times the pairs that cells may keep are counted one by one
LEAST = 3  # occurrences of a shingle from which on the order knows it


class WordHashes(dict):
    """word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingles:
    """The distinct 64-bit shingle hashes of a text, sorted."""

    def __init__(self):
        self.hashes = WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        # On bytes, lower() changes A-Z only, and split() knows just blank and TAB..CR.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        look = self.hashes
        w = np.array([look[x] for x in words], np.uint64)
        span = min(WORDS, len(w))
        h = w[: len(w) - span + 1].copy()
        for k in range(1, span):
            h = h * PRIME + w[k : len(w) - span + 1 + k]
        h += np.uint64(span)
        h ^= h >> np.uint64(32)
        h *= FINAL
        h ^= h >> np.uint64(29)
        return np.unique(h)


def pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys, "<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


def key_of(shingles: np.ndarray) -> np.ndarray:
    return shingles >> np.uint64(64 - 8 * KEY_BYTES)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash per document; equal sets have equal hashes."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches):
            sizes, marks = [], []
            for cell in batch["text"]:
                found = shingles(cell.as_py())
                sizes.append(len(found))
                marks.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_hash"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(measure, "doc_id long, n_shingles long, set_hash binary")


class Order:
    """How often a shingle occurs: exactly for the most frequent, LEAST for others in the bitmap, else 0."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bits: bytes):
        self.keys, self.counts, self.bits = keys, counts, bits

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(self.bits, np.uint8)
        place = keys & np.uint64(len(bits) * 8 - 1)
        some = bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
        rank = some.astype(np.int64) * LEAST
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where(self.keys[at] == keys, self.counts[at], rank)
        return rank


def shingle_order(docs: DataFrame, buckets: int, most: int, most_bits: int = 1 << 28) -> Order:
    """The order by frequency: at most `most` counts, and a bitmap of at most `most_bits`.

    Tasks send each bucket one array of keys per few thousand documents; a bucket's share
    of the shingles is bounded by the number of buckets.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in slices(batches):
            found = [key_of(shingles(cell.as_py())) for cell in batch["text"]]
            keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
            where = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            keys, where = keys[order], where[order]
            ends = np.searchsorted(where, np.arange(buckets + 1))
            used = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(used, pa.int64()),
                    "keys": pa.array([pack(keys[ends[b] : ends[b + 1]]) for b in used], pa.binary()),
                }
            )

    share = -(-most // buckets)

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = np.unique(unpack(b"".join(rows["keys"])), return_counts=True)
        often = counts >= LEAST
        keys, counts = keys[often], counts[often]
        top = np.zeros(len(keys), bool)
        top[np.argsort(-counts, kind="stable")[:share]] = True
        return pd.DataFrame({"key": keys.astype(np.int64), "count": counts, "top": top})

    sent = docs.select("text").mapInArrow(send, "bucket long, keys binary")
    counted = sent.groupBy("bucket").applyInPandas(count, "key long, count long, top boolean")
    counted = staged(counted, "frequent-shingles")
    # At most `most` rows of two numbers come to the driver, and the bitmap in pieces of 4 KB.
    top = counted.filter("top").select("key", "count").toArrow().sort_by("key")
    bits, wanted = 1 << 20, min(most_bits, 16 * counted.count())
    while bits < wanted:
        bits *= 2
    place = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    pieces = counted.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    whole = bytearray(bits // 8)
    for piece, data in pieces.collect():
        whole[(piece - 1) * len(data) : piece * len(data)] = data
    return Order(top["key"].to_numpy().astype(np.uint64), top["count"].to_numpy(), bytes(whole))


def regions(docs: DataFrame, order, buckets: int, percent: int, hot: int) -> DataFrame:
    """region, doc_id, n, place: the members of every shingle region with two or more of them.

    `place` is where the shingle stands in the document's order. Regions with the same members
    are one, that of the earliest shingle. The members of one region meet in a task, but for
    shingles known to be in more than `hot` documents: their members are left as rows, dealt at
    random, and Spark's joins take them from there.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, rank_of = Shingles(), order.value
        for batch in slices(batches):
            parts = []
            for doc, cell in zip(batch["doc_id"].to_pylist(), batch["text"]):
                keys = key_of(shingles(cell.as_py()))
                n = len(keys)
                if not n or doc is None:
                    continue
                length = n - (percent * n + 99) // 100 + 1
                rank = rank_of(keys)
                first = np.lexsort((keys, rank))[:length]
                parts.append((keys[first], rank[first], doc, n))
            if not parts:
                continue
            keys = np.concatenate([p[0] for p in parts])
            ranks = np.concatenate([p[1] for p in parts])
            sizes = [len(p[0]) for p in parts]
            docs_ = np.repeat(np.array([p[2] for p in parts], np.int64), sizes)
            ns = np.repeat(np.array([p[3] for p in parts], np.int32), sizes)
            places = np.concatenate([np.arange(size, dtype=np.int32) for size in sizes])
            is_hot = ranks > hot
            where = (keys % np.uint64(buckets)).astype(np.int64)
            # Hot members go anywhere: buckets from `buckets` on only pass them on.
            where[is_hot] = buckets + docs_[is_hot] % buckets
            by = np.argsort(where, kind="stable")
            keys, docs_, ns, where = keys[by], docs_[by], ns[by], where[by]
            places, ranks = places[by], ranks[by].astype(np.int32)
            ends = np.searchsorted(where, np.arange(2 * buckets + 1))
            used = [b for b in range(2 * buckets) if ends[b] < ends[b + 1]]
            cut = lambda a, b: a[ends[b] : ends[b + 1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(used, pa.int64()),
                    "keys": pa.array([pack(cut(keys, b)) for b in used], pa.binary()),
                    "docs": pa.array([cut(docs_, b).tobytes() for b in used], pa.binary()),
                    "ns": pa.array([cut(ns, b).tobytes() for b in used], pa.binary()),
                    "places": pa.array([cut(places, b).tobytes() for b in used], pa.binary()),
                    "ranks": pa.array([cut(ranks, b).tobytes() for b in used], pa.binary()),
                }
            )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        keys = unpack(b"".join(rows["keys"]))
        docs_ = np.frombuffer(b"".join(rows["docs"]), np.int64)
        ns, places, ranks = (
            np.frombuffer(b"".join(rows[c]), np.int32) for c in ("ns", "places", "ranks")
        )
        if rows["bucket"].iloc[0] >= buckets:
            return pd.DataFrame(
                {"region": keys.astype(np.int64), "doc_id": docs_, "n": ns, "place": places}
            )
        # In the order of the shingles, so that the first of equal regions is the earliest.
        by = np.lexsort((docs_, keys, ranks))
        keys, docs_, ns, places = keys[by], docs_[by], ns[by], places[by]
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[start, len(keys)])
        mixed = (docs_.astype(np.uint64) + PRIME) * FINAL
        mixed ^= mixed >> np.uint64(31)
        mixed *= PRIME
        name = np.add.reduceat(mixed, start) ^ size.astype(np.uint64)
        _, kept = np.unique(name, return_index=True)
        good = np.zeros(len(start), bool)
        good[kept] = True
        good &= size > 1
        members = np.repeat(good, size)
        return pd.DataFrame(
            {
                "region": np.repeat(name, size)[members].astype(np.int64),
                "doc_id": docs_[members],
                "n": ns[members],
                "place": places[members],
            }
        )

    sent = docs.select("doc_id", "text").mapInArrow(
        send,
        "bucket long, keys binary, docs binary, ns binary, places binary, ranks binary",
    )
    met = sent.groupBy("bucket").applyInPandas(meet, "region long, doc_id long, n int, place int")
    return met.groupBy("region", "doc_id", "n").agg(F.min("place").alias("place"))


def verify(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with `both` and `either`: sizes of intersection and union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, own = Shingles(), None, None
        for batch in slices(batches):
            both, either = [], []
            for a, text_a, text_b in zip(
                batch["a"].to_pylist(), batch["text_a"], batch["text_b"]
            ):
                if a != held:
                    held, own = a, shingles(text_a.as_py())
                other = shingles(text_b.as_py())
                # Both are sorted and distinct: what stands twice in the merge is shared.
                merged = np.concatenate([own, other])
                merged.sort(kind="stable")
                shared = int((merged[1:] == merged[:-1]).sum())
                both.append(shared)
                either.append(len(own) + len(other) - shared)
            columns = [batch["a"], batch["b"], pa.array(both, pa.int64()), pa.array(either, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "both", "either"])

    texts = docs.select("doc_id", "text")
    every = pairs.select(F.col("a").alias("doc_id"))
    ends = broadcast_if_small(every)
    if ends is every:
        ends = broadcast_if_small(staged(every.distinct(), "pivots"))
    side_a = texts.join(ends, "doc_id", "left_semi")
    side_b = texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}).join(
        broadcast_if_small(pairs.select("a", "b")), "b"
    )
    joined = side_b.join(side_a.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(
        compare, "a long, b long, both long, either long"
    )


def similarity_components(
    docs: DataFrame,
    percent: int = 80,
    rounds: int = 3,
    order_size: int = 1 << 17,
    bucket_shingles: int = 1 << 21,
    hot: int = 5000,
    partners: int = 32,
) -> DataFrame:
    """row, doc_id, n_shingles, component_id, class_id: one row per document.

    `class_id` is the smallest id with the same shingles, `component_id` the smallest within
    links of 100 * intersection >= percent * union. Regions are cut into Voronoi cells as long as
    a member has more than `partners` others to be compared with, on average.
    """
    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    sets = staged(shingle_sets(numbered), "shingle-sets")
    classes = sets.filter("set_hash IS NOT NULL").groupBy("set_hash").agg(
        F.min("doc_id").alias("class_id"), F.sum("n_shingles").alias("_words")
    )
    classes = staged(classes, "classes")
    total = classes.agg(F.sum("_words")).first()[0] or 0
    buckets = max(8, total // bucket_shingles)
    context = docs.sparkSession.sparkContext
    order = context.broadcast(shingle_order(numbered, buckets, order_size))

    others = sets.join(classes.select("class_id"), sets["doc_id"] == F.col("class_id"), "left_anti")
    others = staged(others.select(F.col("doc_id").alias("_other")).distinct(), "copies")
    # One row per class: repeated rows of its smallest id are alike, one set having one id.
    single = numbered.join(
        broadcast_if_small(others), F.col("doc_id") == F.col("_other"), "left_anti"
    )
    members = staged(regions(single, order, buckets, percent, hot), "regions")
    members = staged(_with_centres(members), "centred")

    known = Known(single, percent)
    tried = None
    for turn in range(rounds):
        pivots = staged(_pivots(members, known.labels, tried, turn), "pivots-of-regions")
        pivots = broadcast_if_small(pivots, NEAR_BYTES)
        used = pivots.select("region", "_doc_id")
        tried = used if tried is None else tried.unionByName(used)
        # Pivots that have no one to meet say nothing about the pairs of other documents.
        known.compare(_pivot_pairs(members, known.labels, percent, pivots))
    cells = staged(_first_cells(members, known), "cells")
    cells = _cut(cells, known, partners)
    known.compare(_cell_pairs(cells, known))
    labels = known.labels
    order.unpersist()

    rows = sets.join(classes.select("set_hash", "class_id"), "set_hash", "left")
    if labels is None:
        rows = rows.withColumn("component", F.lit(None).cast("long"))
    else:
        rows = rows.join(
            labels.withColumnRenamed("doc_id", "_doc"), F.col("class_id") == F.col("_doc"), "left"
        )
    return rows.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "class_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def _with_centres(members: DataFrame) -> DataFrame:
    """The members with `weight`, in how many regions a document lies, and the region's `centre`.

    The text that others were copied from shares shingles with all of them, so it lies in more
    regions than any copy. Joins on hot documents and regions are left to AQE to split.
    """
    weights = members.groupBy(F.col("doc_id").alias("_doc")).agg(F.count(F.lit(1)).alias("weight"))
    weighed = members.join(weights, F.col("doc_id") == F.col("_doc")).drop("_doc")
    centre = F.min(F.struct(-F.col("weight"), F.col("doc_id").alias("centre")))
    centres = weighed.groupBy(F.col("region").alias("_r")).agg(centre.alias("_c"))
    centred = weighed.join(centres, F.col("region") == F.col("_r"))
    return centred.select(*members.columns, "weight", F.col("_c.centre").alias("centre"))


def _open_rows(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The labelled members of regions in several components."""
    rows = _labelled(members, labels)
    open_ = rows.groupBy("region").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return rows.join(open_.filter("_low < _high").select("region"), "region")


def _pivots(
    members: DataFrame, labels: DataFrame | None, tried: DataFrame | None, turn: int
) -> DataFrame:
    """A pivot for each open region: region, _doc_id, _n, _place, _component.

    The region's centre comes first, then the member of most weight outside the centre's
    component that was no pivot of the region (`tried`) before. A member outside it shows that a region is open.
    """
    rows = _labelled(members, labels)
    if turn == 0:
        at = rows.filter("doc_id = centre")
        return at.select("region", *[F.col(c).alias(f"_{c}") for c in ("doc_id", "n", "place", "component")])
    homes = rows.select("region", "weight", "doc_id", "n", "place", "component", F.col("centre").alias("_at"))
    if labels is None:
        homes = homes.withColumn("_home", F.col("_at"))
    else:
        known = labels.select(F.col("doc_id").alias("_doc"), F.col("component").alias("_home"))
        homes = homes.join(known, F.col("_at") == F.col("_doc"), "left").drop("_doc")
        homes = homes.withColumn("_home", F.coalesce("_home", "_at"))
    at = homes.filter("component <> _home")
    if turn > 1:
        before = broadcast_if_small(tried.withColumnRenamed("_doc_id", "doc_id"), NEAR_BYTES)
        at = at.join(before, ["region", "doc_id"], "left_anti")
    columns = ["doc_id", "n", "place", "component"]
    pick = F.min(F.struct(-F.col("weight"), *columns))
    picked = at.groupBy("region").agg(pick.alias("_p"))
    return picked.select("region", *[F.col(f"_p.{c}").alias(f"_{c}") for c in columns])


def _pivot_pairs(
    members: DataFrame, labels: DataFrame | None, percent: int, pivots: DataFrame
) -> DataFrame:
    """Pairs of a region's pivot and its members of other components, as sizes and places allow."""
    met = _labelled(members, labels).join(pivots, "region").filter("component <> _component")
    return _ordered(met.filter(_may_link(percent)), "_doc_id")


def _may_link(percent: int) -> Column:
    """Whether sizes and places let n, place and _n, _place belong to a link."""
    # A link shares 100 * both >= percent * either, so both >= percent / (100 + percent) of the sum.
    rest = F.least(F.col("n") - F.col("place"), F.col("_n") - F.col("_place"))
    sizes = F.least("n", "_n") * 100 >= F.greatest("n", "_n") * percent
    return sizes & (rest * (100 + percent) >= (F.col("n") + F.col("_n")) * percent)


def _ordered(met: DataFrame, other: str) -> DataFrame:
    """The distinct pairs (a, b), a < b, of doc_id and the other column."""
    return met.select(F.least("doc_id", other).alias("a"), F.greatest("doc_id", other).alias("b")).distinct()


class Known:
    """What comparisons have shown: `checked` pairs with their sizes, and the `labels` of what is linked."""

    def __init__(self, docs: DataFrame, percent: int):
        self.docs, self.percent = docs, percent
        self.checked = self.labels = None

    def compare(self, pairs: DataFrame) -> None:
        """Compare the pairs (a, b) that were not yet, and label the documents anew."""
        if self.checked is not None:
            before = broadcast_if_small(self.checked.select("a", "b"), NEAR_BYTES)
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        if pairs.isEmpty():
            return
        sizes = staged(verify(pairs, self.docs, self.percent), "verified")
        self.checked = sizes if self.checked is None else self.checked.unionByName(sizes)
        links = sizes.filter(F.col("both") * 100 >= F.col("either") * self.percent).select("a", "b")
        if links.isEmpty():
            return
        if self.labels is not None:
            # What was linked before is one star a component.
            links = links.unionByName(self.labels.toDF("a", "b"))
        self.labels = broadcast_if_small(components(links), NEAR_BYTES)

    @property
    def reach(self) -> float:
        """The largest distance of a link, a little more than it is."""
        return 1 - self.percent / 100 + 1e-9

    def with_distances(self, rows: DataFrame, pivot: str) -> DataFrame:
        """The rows with `distance` from doc_id to the column, NULL where it was not computed."""
        own = F.when(F.col("doc_id") == F.col(pivot), F.lit(0.0))
        if self.checked is None:
            return rows.withColumn("distance", own)
        measured = self.checked.select(
            F.col("a").alias("_a"), F.col("b").alias("_b"), (1 - F.col("both") / F.col("either")).alias("_d")
        )
        measured = broadcast_if_small(measured, NEAR_BYTES)
        pair = (F.least("doc_id", pivot) == F.col("_a")) & (F.greatest("doc_id", pivot) == F.col("_b"))
        found = rows.join(measured, pair, "left").withColumn("distance", F.coalesce(own, "_d"))
        return found.drop("_a", "_b", "_d")


def _first_cells(members: DataFrame, known: Known) -> DataFrame:
    """Each open region as one cell, all members at home: cell, doc_id, n, place, home, distance, settled.

    `distance` is that to the cell's pivot, here the region's centre, and NULL if unknown; a `settled`
    cell is not cut any more.
    """
    rows = known.with_distances(_open_rows(members, known.labels), "centre")
    home, settled = F.lit(True).alias("home"), F.lit(False).alias("settled")
    return rows.select(F.col("region").alias("cell"), "doc_id", "n", "place", home, "distance", settled)


def _band(n: Column) -> Column:
    """Sizes in bands of 2 %."""
    return F.floor(F.log(n) / math.log(1.02)).cast("int")


def _with_bands(rows: DataFrame, percent: int) -> DataFrame:
    """The rows with `band`, once for each band of the sizes, its own or larger, of sets they may link with."""
    # A link with a set of _n >= n needs 100 * n >= percent * _n and rest * (100 + percent) >= (n + _n) * percent.
    rest = F.floor((F.col("n") - F.col("place")) * (100 + percent) / percent) - F.col("n")
    largest = F.least(F.floor(F.col("n") * 100 / percent), rest)
    bands = F.sequence(_band(F.col("n")), _band(largest))
    return rows.filter(largest >= F.col("n")).withColumn("band", F.explode(bands))


def _wide(cells: DataFrame, known: Known, partners: int) -> DataFrame:
    """Cells to be cut: cell, `size`, members at home `homes`, and the number of pivots `k`."""
    unsettled = cells.filter("NOT settled")
    parts = _labelled(unsettled, known.labels).groupBy("cell", "component").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("home").alias("_h")
    )
    whole = parts.groupBy("cell").agg(
        F.sum("_n").alias("size"),
        F.sum("_h").alias("homes"),
        F.sum(F.col("_n") * F.col("_h")).alias("_same"),
    )
    # Where all are at home, each pair between components is in this twice.
    many = F.col("size") * F.col("homes") - F.col("_same") > 2 * partners * F.col("size")
    pivots = F.least(F.lit(max(2, partners // 2)), F.ceil(F.col("size") / partners) + 1)
    whole = staged(whole.filter(many).select("cell", "size", "homes", pivots.alias("k")), "cells-of-many-members")
    if whole.isEmpty():
        return whole
    whole = broadcast_if_small(whole, NEAR_BYTES)
    # Of these pairs only those count that meet by bands, which the numbers of members in each band tell.
    rows = unsettled.join(whole.select("cell"), "cell", "left_semi")
    held = rows.groupBy("cell", _band(F.col("n")).alias("band")).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if("home").alias("_homes")
    )
    met = _with_bands(rows, known.percent).groupBy("cell", "band").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("home").alias("_h")
    )
    meeting = F.col("_h") * F.col("_all") + (F.col("_n") - F.col("_h")) * F.col("_homes")
    left = met.join(held, ["cell", "band"]).groupBy("cell").agg(F.sum(meeting).alias("_meeting"))
    whole = whole.join(left, "cell").filter(F.col("_meeting") > partners * F.col("size"))
    whole = staged(whole, "cells-of-many-pairs")
    if whole.isEmpty():
        return whole.drop("_meeting")
    whole = broadcast_if_small(whole, NEAR_BYTES)
    # Where they are not too many, those left to be compared are counted.
    few = whole.filter(F.col("_meeting") <= COUNTED * partners * F.col("size"))
    pairs = _meetings(rows.join(few.select("cell"), "cell", "left_semi"), known).groupBy("cell").agg(
        F.count(F.lit(1)).alias("_pairs")
    )
    narrow = few.join(pairs, "cell", "left").filter(
        2 * F.coalesce("_pairs", F.lit(0)) <= partners * F.col("size")
    )
    return whole.drop("_meeting").join(narrow.select("cell"), "cell", "left_anti")


def _cut(cells: DataFrame, known: Known, partners: int) -> DataFrame:
    """The cells after wide ones were cut, until none is left that a cut makes smaller."""
    level = 0
    while True:
        wide = staged(_wide(cells, known, partners), "wide-cells")
        if wide.isEmpty():
            return cells
        rows = cells.join(wide, "cell")
        mixed = F.xxhash64("doc_id", F.lit(level))
        pick = F.min(F.struct(mixed, F.col("doc_id").alias("pivot"))).alias("_p")
        pivots = rows.filter("home").groupBy("cell", F.pmod(mixed, "k").alias("_slot")).agg(pick)
        pivots = staged(pivots.select("cell", F.col("_p.pivot").alias("pivot")), "cell-pivots")
        near = rows.join(pivots, "cell")
        known.compare(_ordered(near.filter("doc_id <> pivot"), "pivot"))
        cut = staged(_voronoi(known.with_distances(near, "pivot"), known.reach, level), "cut")
        good = staged(_worth(cut, wide), "worth-cutting")
        others = cells.join(wide.select("cell"), "cell", "left_anti")
        whole = cells.join(wide.select("cell"), "cell", "left_semi").join(good, "cell", "left_anti")
        parts = cut.join(good.withColumnRenamed("cell", "parent"), "parent", "left_semi").drop("parent")
        whole = whole.withColumn("settled", F.lit(True))
        cells = staged(others.unionByName(whole).unionByName(parts), "cells")
        level += 1


def _voronoi(near: DataFrame, reach: float, level: int) -> DataFrame:
    """The members of new cells with their `parent`, from members with distances to each of its pivots."""
    each = near.groupBy("cell", "doc_id", "n", "place", "home").agg(
        F.collect_list(F.struct("distance", "pivot")).alias("_all")  # as many as the cell has pivots
    )
    each = each.withColumn("_best", F.array_min("_all"))
    at = each.withColumn("_at", F.explode("_all")).filter(
        F.col("_at.distance") <= F.col("_best.distance") + 2 * reach
    )
    at = at.select(
        F.col("cell").alias("parent"),
        F.xxhash64("cell", "_at.pivot", F.lit(level)).alias("cell"),
        "doc_id",
        "n",
        "place",
        (F.col("home") & (F.col("_at.pivot") == F.col("_best.pivot"))).alias("home"),
        F.col("_at.distance").alias("distance"),
        F.lit(False).alias("settled"),
    )
    own = at.filter("home").groupBy("cell").agg(
        F.min("distance").alias("_low"), F.max("distance").alias("_high")
    )
    in_reach = F.col("distance").between(F.col("_low") - reach, F.col("_high") + reach)
    return at.join(own, "cell").filter(in_reach).drop("_low", "_high")


def _worth(cut: DataFrame, wide: DataFrame) -> DataFrame:
    """The cells whose cut saves a quarter of the pairs and doubles the members at most."""
    sizes = cut.groupBy("parent", "cell").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("home").alias("_h")
    )
    after = sizes.groupBy(F.col("parent").alias("cell")).agg(
        F.sum("_n").alias("_members"), F.sum(F.col("_n") * F.col("_h")).alias("_pairs")
    )
    fewer = F.col("_pairs") * 4 <= F.col("size") * F.col("homes") * 3
    return after.join(wide, "cell").filter(fewer).filter("_members <= 2 * size").select("cell")


def _meetings(cells: DataFrame, known: Known) -> DataFrame:
    """Members of a cell with others, one of the two at home, that may be linked across components."""
    rows = _labelled(cells, known.labels)
    columns = ["doc_id", "n", "place", "component", "home", "distance"]
    others = rows.select("cell", _band(F.col("n")).alias("band"), *[F.col(c).alias(f"_{c}") for c in columns])
    met = _with_bands(rows, known.percent).join(others, ["cell", "band"])
    met = met.filter("n < _n OR (n = _n AND doc_id < _doc_id)").filter("component <> _component")
    apart = F.abs(F.col("distance") - F.col("_distance")) > known.reach
    met = met.filter("home OR _home").filter(_may_link(known.percent))
    return met.filter(~F.coalesce(apart, F.lit(False)))


def _cell_pairs(cells: DataFrame, known: Known) -> DataFrame:
    """The pairs of all cells that are to be compared."""
    return _ordered(_meetings(cells, known), "_doc_id")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("doc_id"))
    known = labels.withColumnRenamed("doc_id", "_doc")
    return (
        members.join(known, F.col("doc_id") == F.col("_doc"), "left")
        .drop("_doc")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )


def keep_representatives(docs: DataFrame, **options) -> DataFrame:
    """The document with the smallest id of each component, and every document without words.

    Where ids are missing or come more than once, rows are told apart by numbers of their own, written
    down first: different texts under one id are different documents, and of rows repeated whole one stays.
    """
    ids = docs.groupBy("doc_id").count()
    if ids.filter("count > 1 OR doc_id IS NULL").isEmpty():
        found = similarity_components(docs, **options)
        gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
        gone = broadcast_if_small(staged(gone, "near-copies"))
        return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    numbered = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = similarity_components(numbered.select(F.col("_row").alias("doc_id"), "text"), **options)
    found = found.select(F.col("doc_id").alias("_at"), "n_shingles", "component_id")
    same = F.when(F.col("n_shingles") > 0, F.col("component_id").cast("string")).otherwise(
        F.sha2(F.to_json(F.struct("doc_id", "text")), 256)
    )
    rows = numbered.join(found, F.col("_row") == F.col("_at")).select("_row", "doc_id", same.alias("_same"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))
    stays = rows.groupBy("_same").agg(first.alias("_first")).select(F.col("_first._row").alias("_stays"))
    stays = broadcast_if_small(staged(stays, "representatives"))
    return numbered.join(stays, F.col("_row") == F.col("_stays"), "left_semi").drop("_row")
