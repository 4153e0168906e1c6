"""Collocations per language by Toivonen's sampling: exact counts of frequent phrases in few passes.

1. A sample of the documents proposes phrases: levels of one, two, three ... words are counted on it
   with a lowered support, each level only where both shorter parts were frequent there.
2. One pass over all documents counts the proposed phrases and their negative border. The border are
   the phrases that were not proposed although both their shorter parts were, so a phrase is counted
   where the parts it starts and ends with were proposed; all single words are counted.
3. A phrase of the border that turns out frequent may have frequent extensions that nobody counted.
   The expansion pass counts every phrase not counted so far whose counted parts are all frequent.
   A part that is itself counted only now is taken as possibly frequent, so all levels close in
   this pass: what it leaves out has a part that is known to be rare.

The border is far larger than the result, so the second step sends hashes of 48 bits, packed by
ranges, and their counts. That a hash reaches the support proves nothing about the phrases behind it,
but one that doesn't is rare for sure. The third step therefore counts the phrases of all hashes that
reached it by their words, in the same pass as the expansion; the result comes from these counts.

Tasks know proposed and frequent hashes as a bitmap of at most 32 MB. A phrase that is in it by
chance is counted for nothing: a bitmap too small for its phrases costs time, not results.

Defined results: NULL texts count as empty, a NULL language is `und`; empty texts and pieces
without words give nothing; rows repeated whole count each time; an empty table gives no rows.
Only `doc_id`, `lang` and `text` are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftspark.llm.common import WORD, slices, staged, text_of

LONGEST = 5
END = 0  # the number of the mark between pieces
# A-Z to lower case; what separates pieces (fixed set) to a full stop, which no word contains.
PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 10
)
PRIME = np.uint64(0x9E3779B185EBCA87)
FINAL = np.uint64(0xC2B2AE3D27D4EB4F)
BLOCK_BYTES = 8 << 20  # of text that a task takes at once
MOST_WORDS = 1 << 20  # that a task keeps numbers for
MOST_KEYS = 8 << 20  # that a task adds up before it sends them
KEY_BITS, KEY_BYTES = 48, 6
BUCKET_KEYS = 1 << 22  # occurrences for each group in which counts meet


class Words(dict):
    """word -> number, in order of appearance; END is the full stop."""

    def __init__(self):
        super().__init__({b".": END})
        self.texts, self.hashes = [b"."], [0]

    def forget(self) -> None:
        """Start anew, so that memory stays bounded; numbers of words change."""
        self.clear()
        self.__init__()

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.texts)
        self.texts.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


class Phrases:
    """The words of many texts of one language in a row, and hashes of their phrases."""

    def __init__(self, lang: str, texts: list[bytes], words: Words):
        plain = b".".join(texts).translate(PLAIN).replace(b".", b" . ")
        self.ids = np.array([words[w] for w in plain.split()], np.int64)
        self.hashes = np.array(words.hashes, np.uint64)[self.ids]
        self.lang = lang
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang))

    def single(self) -> tuple[np.ndarray, np.ndarray]:
        """Where words stand, and the hashes of these phrases of one word."""
        at = np.flatnonzero(self.ids != END)
        return at, self.hashes[at]

    def longer(self, at, raw, m) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of m words both whose parts of m - 1 words are given: index of the first part, place, hash."""
        first = np.flatnonzero(at[1:] == at[:-1] + 1)
        return first, at[first], raw[first] * PRIME + self.hashes[at[first] + m - 1]

    def keys(self, raw: np.ndarray, m: int) -> np.ndarray:
        key = (raw ^ self.seed) * PRIME + np.uint64(m)
        key ^= key >> np.uint64(32)
        key *= FINAL
        key ^= key >> np.uint64(29)
        return key >> np.uint64(64 - KEY_BITS)


class Bitmap:
    """Which hashes were put in; others are taken to be in by chance, more of them as it fills."""

    def __init__(self, data: bytes):
        self.data = data

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(self.data, np.uint8)
        place = keys & np.uint64(len(bits) * 8 - 1)
        return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _bitmap(keys: DataFrame, most_bits: int) -> Bitmap:
    """A bitmap of the keys, put together by Spark in pieces of 4 KB, at most `most_bits` / 8 bytes."""
    bits, wanted = 1 << 20, min(most_bits, 64 * keys.count())
    while bits < wanted:
        bits *= 2
    place = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    pieces = keys.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    whole = bytearray(bits // 8)
    for piece, data in pieces.collect():
        whole[(piece - 1) * len(data) : piece * len(data)] = data
    return Bitmap(bytes(whole))


def _proposed(text: Phrases, proposed: Bitmap, levels: range) -> Iterator[np.ndarray]:
    """Hashes of the phrases both whose parts were proposed: of the proposed ones and of their border."""
    at, raw = text.single()
    for m in range(2, levels.stop):
        kept = proposed(text.keys(raw, m - 1))
        _, at, raw = text.longer(at[kept], raw[kept], m)
        if m in levels:
            yield text.keys(raw, m)


def _possible(
    text: Phrases, proposed: Bitmap, frequent: Bitmap, longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """m, places and hashes of phrases that `_proposed` found frequent, and of those it left out
    although no part of them is known to be rare."""
    at, raw = text.single()
    counted = np.ones(len(at), bool)
    for m in range(1, longest + 1):
        if m > 1:
            first, at, raw = text.longer(at, raw, m)
            counted = extended[first] & extended[first + 1]
        key = text.keys(raw, m)
        good = ~counted | frequent(key)
        at, raw, key, counted = at[good], raw[good], key[good], counted[good]
        yield m, at, key
        extended = counted & proposed(key)  # `_proposed` went on from here


def _texts(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[Phrases]:
    """The rows' texts in blocks of one language."""
    held, size = {}, 0
    for batch in slices(batches):
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= BLOCK_BYTES:
                for key, texts in held.items():
                    yield Phrases(key, texts, words)
                held, size = {}, 0
    for key, texts in held.items():
        yield Phrases(key, texts, words)


def _hash_counts(
    docs: DataFrame, phrases: Callable[[Phrases], Iterator[np.ndarray]], least: int, occurrences: int
) -> DataFrame:
    """key, n of the hashes that `phrases` yields `least` times or more for all texts."""
    split = max(0, (occurrences // BUCKET_KEYS).bit_length())
    shift = np.uint64(KEY_BITS - split)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(), [], 0

        def packed() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(keys >> shift, np.arange((1 << split) + 1, dtype=np.uint64))
            used = np.flatnonzero(np.diff(ends))
            short = keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            n = n.astype("<u4")
            return pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(used, pa.int64()),
                    "keys": pa.array([short[ends[b] : ends[b + 1]].tobytes() for b in used], pa.binary()),
                    "counts": pa.array([n[ends[b] : ends[b + 1]].tobytes() for b in used], pa.binary()),
                }
            )

        for text in _texts(batches, words):
            for keys in phrases(text):
                held.append(keys)
                size += len(keys)
            if size >= MOST_KEYS:
                yield packed()
                held, size = [], 0
            if len(words) > MOST_WORDS:
                words.forget()
        if size:
            yield packed()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        short = np.frombuffer(b"".join(rows["keys"]), np.uint8).reshape(-1, KEY_BYTES)
        keys = np.zeros((len(short), 8), np.uint8)
        keys[:, :KEY_BYTES] = short
        keys = keys.view("<u8").ravel()
        n = np.frombuffer(b"".join(rows["counts"]), "<u4")
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        total = np.add.reduceat(n, first, dtype=np.int64)
        often = total >= least
        return pd.DataFrame({"key": keys[first][often].astype(np.int64), "n": total[often]})

    sent = docs.mapInArrow(send, "bucket long, keys binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(add, "key long, n long")


def _phrase_counts(docs: DataFrame, phrases: Callable, least: int, occurrences: int) -> DataFrame:
    """lang, m, phrase, n: what `phrases` yields `least` times or more, told apart by the phrases
    themselves, and for each language a row of level 0 with the number of all its words.

    Lists of phrases with their counts travel in ranges of their hashes and are added up there.
    """
    split = max(0, (occurrences // BUCKET_KEYS).bit_length())
    shift, ranges = np.uint64(KEY_BITS - split), np.arange((1 << split) + 1, dtype=np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()

        def rows(lang, m, texts, n, ends) -> pa.RecordBatch:
            used = len(ends) - 1
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in (texts, n)]
            columns = [pa.array(np.arange(used)), pa.array([lang] * used, pa.string()), pa.array([m] * used, pa.int32())]
            return pa.RecordBatch.from_arrays(columns + lists, names=["bucket", "lang", "m", "phrases", "counts"])

        for text in _texts(batches, words):
            n = int((text.ids != END).sum())
            yield rows(text.lang, 0, pa.array([""]), pa.array([n]), [0, 1])
            known = pa.array(words.texts, pa.binary())
            for m, at, keys in phrases(text):
                keys, where, n = np.unique(keys, return_index=True, return_counts=True)
                if len(n):
                    parts = [known.take(pa.array(text.ids[at[where] + k])) for k in range(m)]
                    texts = pc.binary_join_element_wise(*parts, b" ").cast(pa.string())
                    yield rows(text.lang, m, texts, pa.array(n, pa.int64()), np.searchsorted(keys >> shift, ranges))
            if len(words) > MOST_WORDS:
                words.forget()

    def add(rows: pa.Table) -> pa.Table:
        lists = rows.combine_chunks()
        parent = pc.list_parent_indices(lists["phrases"])
        flat = lists.select(["lang", "m"]).take(parent)
        flat = flat.append_column("phrase", pc.list_flatten(lists["phrases"]))
        flat = flat.append_column("n", pc.list_flatten(lists["counts"]))
        added = flat.group_by(["lang", "m", "phrase"]).aggregate([("n", "sum")])
        added = added.rename_columns(["lang", "m", "phrase", "n"])
        return added.filter((pc.field("m") == 0) | (pc.field("n") >= least))

    sent = docs.mapInArrow(count, "bucket long, lang string, m int, phrases array<string>, counts array<long>")
    return sent.groupBy("bucket").applyInArrow(add, "lang string, m int, phrase string, n long")


def frequent_phrases(
    docs: DataFrame,
    support: int = 100,
    longest: int = LONGEST,
    one_in: int = 8,
    lowered: float = 0.4,
    most_bits: int = 1 << 28,
) -> DataFrame:
    """lang, m, phrase, n of every phrase of up to `longest` words that occurs `support` times
    or more; level 0 has the number of all words of each language.

    The sample takes one document in `one_in`, by hash; a phrase is proposed from `lowered` times
    the support that is to be expected there. Both change the passes' cost, never the result.
    """
    share = docs.sparkSession.sparkContext.broadcast
    texts = docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text")
    )
    chosen = F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(one_in)) == 0
    sample = staged(texts.filter(chosen).select("lang", "text"), "sample")
    texts = texts.select("lang", "text")
    least = max(2, int(lowered * support / one_in))
    words = sample.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0

    def singles(text: Phrases) -> Iterator[np.ndarray]:
        yield text.keys(text.single()[1], 1)

    proposed = staged(_hash_counts(sample, singles, least, words), "proposed")
    for m in range(2, longest + 1):
        known = share(_bitmap(proposed, most_bits))
        one = range(m, m + 1)
        level = _hash_counts(sample, lambda text: _proposed(text, known.value, one), least, words)
        level = staged(level, "proposed")
        if level.isEmpty():
            break
        proposed = proposed.unionByName(level)
    known, levels = share(_bitmap(proposed, most_bits)), range(2, longest + 1)

    def bordered(text: Phrases) -> Iterator[np.ndarray]:
        yield from singles(text)
        yield from _proposed(text, known.value, levels)

    counted = staged(_hash_counts(texts, bordered, support, words * one_in * longest), "counted")
    often = share(_bitmap(counted, most_bits))
    occurrences = counted.agg(F.sum("n")).first()[0] or 0

    def possible(text: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        yield from _possible(text, known.value, often.value, longest)

    return staged(_phrase_counts(texts, possible, support, occurrences), "frequent-phrases")


def collocations(docs: DataFrame, support: int = 100, top: int = 2000, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of two words or more.

    A phrase's score is 1000 times its occurrences over those expected if the two sides of its
    weakest cut met by chance. Phrases that lie inside a longer one as often as they occur are dropped.
    """
    found = frequent_phrases(docs, support, **options)
    totals = found.filter("m = 0").select("lang", F.col("n").alias("words"))
    phrases = found.filter("m > 0").select("lang", "phrase", "n")
    candidates = found.filter("m > 1").select(
        "lang", "m", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w")
    )

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.select(
        "lang", "m", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k", part(1, F.col("k")).alias("head"), part(F.col("k") + 1, F.col("m")).alias("tail")
    )
    heads = phrases.toDF("lang", "head", "l")
    tails = phrases.toDF("lang", "tail", "r")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    # Both products fit 38 digits: counts of up to 10^15 against 10^18 and 10^19.
    score = F.expr(
        "CAST(1000 * a AS DECIMAL(18, 0)) * CAST(words AS DECIMAL(19, 0)) "
        "DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(19, 0)))"
    )
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"),
        F.first("a").alias("a"),
        F.first("words").alias("n"),
    )
    # A phrase is found inside some longer one as often only if one by a single word holds it as often.
    longer = candidates.filter("m > 2").select(
        "lang", F.explode(F.array(part(1, F.col("m") - 1), part(2, F.col("m")))).alias("phrase"), "a"
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    alone = weakest.join(longer, ["lang", "phrase"], "left").filter("_longer IS NULL OR _longer < a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = alone.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    # First among a sixteenth of the phrases, so that no task ranks all of a language.
    part_of = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(16))).orderBy(*order)
    rows = rows.withColumn("_place", F.row_number().over(part_of)).filter(F.col("_place") <= top).drop("_place")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
