"""Benchmark decontamination with spaced seeds.

Words are compared in lower case and without marks. A seed is two blocks of three words with a gap of
0, 3 or 6 words between them; the masks are fixed, and the words in the gap don't count. Of any
12 words in four blocks, two blocks are whole if at most two words were substituted, and
two whole blocks are one of these seeds: so every passage of `window` = 12 words with at least
`min_matches` = 10 in place shares a seed hash with its item. An item shorter than the window may lack
one word or none; the mask of a single block finds it, as one more block than words may be lacking is taken
of it, side by side. Each hit is then verified: along its diagonal the words in place are counted in
every window. The masks promise this for windows of 12 words or more with at most two substitutions;
other parameters are refused.

Training texts stay where they are. Their positions are first held against the items' block hashes,
which nearly none passes; the rest become seed hashes and meet the items' in a join. The
benchmark's side is broadcast if its measured size allows, else the join shuffles.

Defined results: NULL and empty texts hit nothing; items under `min_words` = 5 words are phrases, not
passages, and are hit by nothing; items shorter than the window are one window, of which the same share must
be in place; repeated rows are hit alike; rows that differ in text under one id are told apart; an
empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import let, staged, text_of, words_of
from siftspark.operators.scope import broadcast_if_small

BLOCK = 3
# How far a mask's second block begins after its first.
MASKS = (3, 6, 9)
BLOCKS = 4  # that the masks choose two of
MARKS = r"[^\p{L}\p{N}\x20\x09-\x0D]+"


def plain_words(text: Column) -> Column:
    """The words in lower case without marks; words of marks alone are none."""
    return let(F.regexp_replace(F.lower(text), MARKS, ""), words_of)


def blocks(words: Column) -> Column:
    """For each position: place, hash of its block, and the hashes of the blocks the masks pair it with.

    A block that runs over the end has hash NULL.
    """

    def of_hashes(hashes: Column) -> Column:
        return F.transform(
            hashes,
            lambda h, i: F.struct(
                i.alias("place"),
                h.alias("block"),
                *[F.get(hashes, i + m).alias(f"block_{m}") for m in MASKS],
            ),
        )

    hashes = F.transform(
        words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )
    return let(F.slice(hashes, 1, F.greatest(F.size(words) - BLOCK + 1, F.lit(0))), of_hashes)


def seeds(positions: DataFrame) -> DataFrame:
    """The positions with `seed`, a hash for each mask that fits there; `lone` blocks are one by themselves."""
    made = F.array(
        F.when(F.col("lone"), F.xxhash64(F.lit(0), "block")),
        *[
            F.when(
                F.col(f"block_{m}").isNotNull(), F.xxhash64(F.lit(m), "block", f"block_{m}")
            )
            for m in MASKS
        ],
    )
    kept = [c for c in positions.columns if not c.startswith("block") and c != "lone"]
    return positions.select(*kept, F.explode(F.array_compact(made)).alias("seed"))


def _positions(df: DataFrame, keys: list[str], words: Column) -> DataFrame:
    return df.select(*keys, F.explode(let(words, blocks)).alias("_p")).select(*keys, "_p.*")


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 12,
    min_matches: int = 10,
    min_words: int = BLOCK + 2,
) -> DataFrame:
    """doc_id, text_hash, item_id, best_window: the items of which a document has a passage."""
    lacking = window - min_matches
    if window < BLOCK * BLOCKS or not 0 <= lacking <= BLOCKS - 2 or min_words < BLOCK:
        raise ValueError(f"the masks don't find every {min_matches} of {window} words from {min_words} on")
    items = benchmark.select("item_id", plain_words(text_of()).alias("item_words"))
    items = staged(items.filter(F.size("item_words") >= min_words), "items")
    # Of a short item as many blocks stand by themselves as words may be lacking, and one more.
    size = F.size("item_words")
    alone = F.when(size < window, F.floor(size * lacking / window) + 1).otherwise(0)
    item_positions = _positions(
        items.withColumn("_alone", alone), ["item_id", "_alone"], F.col("item_words")
    )
    lone = (F.col("place") % BLOCK == 0) & (F.col("place") < F.col("_alone") * BLOCK)
    item_positions = item_positions.withColumn("lone", lone).drop("_alone")
    item_seeds = staged(
        seeds(item_positions).withColumnRenamed("place", "item_place"), "item-seeds"
    )
    used = F.col("lone") | F.col(f"block_{MASKS[0]}").isNotNull()
    item_blocks = staged(
        item_positions.filter(used).groupBy("block").agg(F.bool_or("lone").alias("lone")),
        "item-blocks",
    )
    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().alias("_t"))
    found = _positions(texts, ["doc_id", "text_hash"], plain_words(F.col("_t")))
    found = found.join(broadcast_if_small(item_blocks), "block")
    hits = staged(
        seeds(found)
        .join(broadcast_if_small(item_seeds), "seed")
        .select(
            "doc_id", "text_hash", "item_id", (F.col("place") - F.col("item_place")).alias("shift")
        )
        .distinct(),
        "seed-hits",
    )
    return _verified(texts, hits, items, window, min_matches)


def _verified(
    texts: DataFrame, hits: DataFrame, items: DataFrame, window: int, min_matches: int
) -> DataFrame:
    """Count the words in place along each hit's diagonal; the item's best window decides."""
    pairs = staged(hits.join(broadcast_if_small(items), "item_id"), "aligned")
    keys = pairs.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "item_id", "shift", "item_words"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    joined = texts.join(broadcast_if_small(keys), same)
    size = F.size("item_words")

    def in_place(words: Column) -> Column:
        return F.transform(
            F.col("item_words"),
            lambda w, i: F.coalesce(F.get(words, i + F.col("shift")) == w, F.lit(False)).cast("int"),
        )

    def best(flags: Column) -> Column:
        sums = F.transform(
            F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1))),
            lambda s: F.aggregate(F.slice(flags, s, window), F.lit(0), lambda a, b: a + b),
        )
        return F.array_max(sums)

    counted = joined.select(
        "doc_id",
        "text_hash",
        "item_id",
        size.alias("_size"),
        let(let(plain_words(F.col("_t")), in_place), best).alias("best_window"),
    )
    whole = F.least(F.col("_size"), F.lit(window))
    enough = F.col("best_window") * window >= whole * min_matches
    return (
        counted.filter(enough)
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max("best_window").alias("best_window"))
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that have a passage of any item."""
    found = staged(find_passages(docs, benchmark, **options), "passages")
    bad = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_of()) == F.col("_hash"))
    return docs.join(broadcast_if_small(staged(bad, "contaminated")), same, "left_anti")
