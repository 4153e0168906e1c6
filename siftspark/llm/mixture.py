"""Mixing sources to target weights, by cuts in hash-random order.

Every document gets a hash-random key. A source's key range is cut into about sqrt(rows) equal
ranges, so both the rows of a range and the ranges of a source stay near sqrt(rows), however
hot the source: rows are sorted and summed inside their range, range totals are summed along the
source, and the two together are the distributed prefix sum of a document's words. The budget of a
source is some whole epochs plus a rest; the rest is cut where the prefix sum reaches it, inside
a document if need be, so every source meets its budget to the word.

Defined results: NULL and blank texts have size 0 and take nothing; a NULL source is a source
like any other, last in order; rows repeated whole are documents of their own; an empty table gives an
empty one. Runs agree: keys hash the id, ties
fall to the id and then to the text's hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftspark.llm.common import staged, text_of, word_count
from siftspark.operators.ranking import row_numbers
from siftspark.operators.scope import broadcast_if_small

KEY_BITS = 40


def _random_key(seed: int) -> Column:
    """The first KEY_BITS bits of the MD5 of seed and id, which other engines can compute too."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def _level(sources: DataFrame, cap: int) -> float:
    """Words a unit of weight is worth, once what capped sources can't use is reshared.

    The driver sees four sums a round; sources capped in one round stay capped.
    """
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > F.col("source_size") * cap
        row = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, F.col("source_size") * cap)).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if not row["words"] or not row["weight"]:
            return level
        following = max(level, (row["words"] - (row["capped"] or 0)) / row["weight"])
        if following == level:
            return level
        level = following


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """source, source_no, source_size, rows, weight, target: one row per source."""
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    ordered = row_numbers(
        totals.withColumn("_last", F.col("source").isNull()), ["_last", "source"], name="source_no"
    )
    given = F.array(*[F.lit(w) for w in weights])
    place = ((F.col("source_no") - 1) % len(weights)).cast("int")
    sources = staged(ordered.withColumn("weight", given[place]).drop("_last"), "sources")
    share = F.col("weight") * F.lit(_level(sources, cap))
    target = F.least(share, (F.col("source_size") * cap).cast("double"))
    return sources.withColumn("target", target)


def mixture(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    seed: int = 20,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken; and the columns to carry, as _carry_NAME.

    `weights` repeat along the sources in code point order and share the words of all
    documents; no source gives more than `cap` times its words.
    """
    text = text_of()
    columns = [
        F.col("doc_id"),
        F.col("source"),
        word_count(text).alias("size"),
        _random_key(seed).alias("_key"),
        F.xxhash64(text).alias("_tie"),
    ]
    sized = staged(docs.select(*columns), "sized")
    targets = staged(source_targets(sized, weights, cap), "targets")
    rows = sized
    if carry:
        rows = docs.select(*columns, *[F.col(c).alias(f"_carry_{c}") for c in carry])

    known = targets.withColumnRenamed("source", "_source")
    rows = rows.join(
        broadcast_if_small(known), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    ranges = F.ceil(F.sqrt("rows")).cast("long")
    rows = rows.withColumn("_range", F.shiftright(F.col("_key") * ranges, KEY_BITS))

    known_ranges = sized.join(
        broadcast_if_small(known), F.col("source").eqNullSafe(F.col("_source"))
    ).withColumn("_range", F.shiftright(F.col("_key") * ranges, KEY_BITS))
    along = Window.partitionBy("source_no").orderBy("_range")
    offsets = (
        known_ranges.groupBy("source_no", "_range")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_offset", F.sum("_words").over(along) - F.col("_words"))
        .drop("_words")
    )
    inside = (
        Window.partitionBy("source_no", "_range")
        .orderBy("_key", "doc_id", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumn("_before", F.sum("size").over(inside) - F.col("size"))
    placed = summed.join(offsets, ["source_no", "_range"])

    budget = F.round("target").cast("long")
    divisor = F.greatest(F.col("source_size"), F.lit(1))
    rest = budget % divisor - F.col("_offset") - F.col("_before")
    zero = F.lit(0).cast("long")
    cut = F.least(F.greatest(rest, zero), F.col("size"))
    epochs = F.floor(budget / divisor).cast("long")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + cut).alias("taken"),
        *[F.col(f"_carry_{c}") for c in carry],
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row for each epoch of a document, with doc columns, epoch and words.

    All rows but a source's last are whole documents; the one in which the budget ends is cut there.
    Documents without words are in no budget and appear once. Columns of the names epoch and
    words are replaced.
    """
    names = [c for c in docs.columns if c not in ("epoch", "words")]
    taken = mixture(docs, carry=tuple(names), **options)
    size = F.greatest("size", F.lit(1))
    copies = F.when(F.col("size") == 0, 1).otherwise(F.ceil(F.col("taken") / size)).cast("int")
    rows = taken.withColumn(
        "epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)))
    ).withColumn(
        "words", F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    )
    whole = F.col("_carry_text")
    cut = F.when(F.col("words") < F.col("size"), first_words(whole, F.col("words")))
    columns = {c: F.col(f"_carry_{c}") for c in names}
    columns["text"] = F.coalesce(cut, whole)
    if "n_chars" in columns:
        columns["n_chars"] = F.when(cut.isNull(), columns["n_chars"]).otherwise(F.length(cut))
    return rows.select(*[v.alias(c) for c, v in columns.items()], "epoch", "words")
