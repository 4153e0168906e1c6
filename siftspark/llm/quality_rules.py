"""Quality rules: how far a document's histograms diverge from its language's.

Two histograms describe a text: characters by class, and words by the commonest words of the
language (all other words in one class). References are the sums over all documents of a language,
so they are counted from the corpus, not assumed; any word may be a common one. The Jensen-Shannon distance (base 2, 0 to 1) of a
document from its reference is held against a limit, but only for texts long enough for a
histogram to mean something. Everything is SQL on one row's own text; rows are exploded
only to count words per language, and that count is added up before its shuffle.

Base rules come first: too few words, or too many words in repeated 3-word windows.

Defined results: NULL and blank texts have no words and fail the base rules; a NULL language is one of
its own; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftspark.llm.common import let, staged, text_of, words_of
from siftspark.operators.scope import broadcast_if_small

# Character classes as regular expressions, beside blanks and small letters.
CLASSES = {
    "upper": r"[A-Z]",
    "digit": r"[0-9]",
    "mark": r"[.,;:!?'\"()\-]",
    "symbol": r"[#*$%&|<>@+=/\\_~^{}\[\]`]",
    "wide": r"[^\x00-\x7F]",
}
SYMBOLS = r"[#*$%&|<>]"
NON_BLANK = r"[^\x20\x09-\x0D]"



def class_counts(text: Column, word_chars: Column) -> Column:
    """Characters by class as an array of longs: the classes, blanks, and what is left."""
    counts = F.array(*[F.regexp_count(text, F.lit(p)).cast("long") for p in CLASSES.values()])

    def whole(known: Column) -> Column:
        others = F.aggregate(known, F.lit(0).cast("long"), lambda s, v: s + v)
        return F.concat(known, F.array(F.length(text) - word_chars, word_chars - others))

    return let(counts, whole)


def _shift(name: str, value: Column, bits: Column) -> Column:
    return F.call_function(name, value, bits)


def place_bits(words: Column) -> Column:
    return F.length(F.bin(F.size(words)))


def packed_windows(words: Column, hashed: Callable[..., Column] = F.xxhash64) -> Column:
    """The 3-word windows of a text in which two hash alike, none of any other text.

    A window is one number: its hash above, its place below, with as many bits for the
    place as the text needs. Sorted, windows of one hash are neighbours.
    """

    def of_windows(hashes: Column) -> Column:
        twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
        packed = let(
            place_bits(words),
            lambda bits: F.transform(
                hashes, lambda h, i: _shift("shiftleft", h, bits).bitwiseOR(i.cast("long"))
            ),
        )
        return F.when(twice, packed).otherwise(F.array().cast("array<bigint>"))

    all_windows = F.transform(
        words, lambda w, i: hashed(w, F.get(words, i + 1), F.get(words, i + 2))
    )
    whole = F.slice(all_windows, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.coalesce(let(whole, of_windows), F.array().cast("array<bigint>"))


def repeated_words(words: Column, windows: Column) -> Column:
    """Words under windows that the text has twice or more, first ones included, each word once.

    `windows` are the packed windows in order; neighbours of one hash count if their words agree.
    Should the part of the hash that is kept be one for different windows of a text, the windows
    themselves are sorted instead.
    """

    def exact() -> Column:
        named = F.transform(
            F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
            lambda w, i: F.struct(
                F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("window"),
                i.alias("place"),
            ),
        )

        def of_sorted(rows: Column) -> Column:
            def same(x: Column, i: Column) -> Column:
                other = F.get(rows, i)
                return F.coalesce(x["window"] == other["window"], F.lit(False))

            twins = F.filter(rows, lambda x, i: same(x, i - 1) | same(x, i + 1))
            return let(F.transform(twins, lambda x: x["place"]), under)

        return let(F.sort_array(named), of_sorted)

    def of_bits(bits: Column) -> Column:
        low = _shift("shiftleft", F.lit(1).cast("long"), bits) - 1

        def place(x: Column) -> Column:
            return x.bitwiseAND(low).cast("int")

        def alike(x: Column, y: Column) -> Column:
            return _shift("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0

        def agree(x: Column, y: Column) -> Column:
            same = [F.get(words, place(x) + k) == F.get(words, place(y) + k) for k in range(3)]
            return same[0] & same[1] & same[2]

        def twin(x: Column, y: Column) -> Column:
            # Outside the array there is no neighbour, and NULL is no twin.
            return alike(x, y) & agree(x, y)

        def mixed(x: Column, i: Column) -> Column:
            before = F.get(windows, i - 1)
            return alike(x, before) & ~agree(x, before)

        twins = F.filter(
            windows,
            lambda x, i: twin(x, F.get(windows, i - 1)) | twin(x, F.get(windows, i + 1)),
        )
        known = let(F.transform(twins, place), under)
        return F.when(F.size(F.filter(windows, mixed)) > 0, exact()).otherwise(known)

    def under(places: Column) -> Column:
        second = F.transform(places, lambda i: i + 1)
        third = F.transform(places, lambda i: i + 2)
        return F.size(F.array_distinct(F.concat(places, second, third)))

    return F.when(F.size(windows) == 0, F.lit(0)).otherwise(let(place_bits(words), of_bits))


def measures(
    text: Column, words: Column, windows: Column, common: Column, n_common: int
) -> Column:
    """The base measures, class counts and word histogram of a text, as one struct.

    Nested lets keep each array to one evaluation; as one expression per row the
    parts also stay small enough for the JVM to compile.
    """

    def of_chars(word_chars: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NON_BLANK))
        return F.struct(
            F.length(text).alias("chars"),
            F.size(words).cast("long").alias("n_words"),
            word_chars.alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long")
            .alias("n_dup_lines"),
            repeated_words(words, windows).cast("long").alias("n_repeat_words"),
            class_counts(text, word_chars).alias("classes"),
            word_histogram(words, common, n_common).alias("histogram"),
        )

    return let(F.length(F.array_join(words, "")).cast("long"), of_chars)


def common_words(docs: DataFrame, common: int) -> DataFrame:
    """_lang, common: the commonest words in all texts of a language.

    Each task adds up the counts of its words before the shuffle.
    """
    words = docs.select(F.col("lang").alias("_lang"), F.explode(words_of(text_of())).alias("_word"))
    counts = words.groupBy("_lang", "_word").count()
    # Ranked in 64 parts first, so that a language's words don't meet in one task.
    counts = counts.withColumn("_part", F.pmod(F.xxhash64("_word"), F.lit(64)))
    for keys in (["_lang", "_part"], ["_lang"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("count"), "_word")
        counts = counts.withColumn("_rank", F.row_number().over(order)).filter(
            F.col("_rank") <= common
        )
    top = F.array_sort(F.collect_list(F.struct("_rank", "_word")))
    return counts.groupBy("_lang").agg(F.transform(top, lambda t: t["_word"]).alias("common"))


def word_histogram(words: Column, common: Column, n_common: int) -> Column:
    """Words by their place in the language's common words, other words first.

    Words longer than every common word are passed over at once.

    Places of common words are sorted beside one more of each place and one beyond, so a
    place's words are the steps between two first occurrences.
    """
    longest = F.coalesce(F.array_max(F.transform(common, F.length)), F.lit(0))
    short = let(longest, lambda n: F.filter(words, lambda w: F.length(w) <= n))
    places = F.transform(
        short, lambda w: F.coalesce(F.array_position(common, w), F.lit(0).cast("long"))
    )
    ends = F.sequence(F.lit(1), F.lit(n_common + 1)).cast("array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(n_common))

    def counts(hits: Column) -> Column:
        firsts = F.transform(ends, lambda k: F.array_position(hits, k))
        others = F.size(words) - F.size(hits) + n_common + 1
        return let(
            firsts,
            lambda at: F.concat(
                F.array(others.cast("long")),
                F.transform(steps, lambda k: F.get(at, k) - F.get(at, k - 1) - 1),
            ),
        )

    found = F.filter(places, lambda p: p > 0)
    return let(F.sort_array(F.concat(found, ends)), counts)


def summed(column: str, size: int) -> Column:
    """The sum of arrays, place by place."""
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)])


def _js_parts(a: str, b: str) -> tuple[Column, Column, Column]:
    """Both totals, and the distance in terms of them."""

    def total(x: str) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def term(x: Column, y: Column) -> Column:
        p, q = x / F.col("_total_a"), y / F.col("_total_b")
        return 0.5 * part(p, (p + q) / 2) + 0.5 * part(q, (p + q) / 2)

    divergence = F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda s, v: s + v)
    return (
        F.greatest(total(a), F.lit(1)).alias("_total_a"),
        F.greatest(total(b), F.lit(1)).alias("_total_b"),
        F.when((total(a) > 0) & (total(b) > 0), F.sqrt(F.greatest(divergence, F.lit(0.0)))),
    )


def with_distance(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Jensen-Shannon distance of two count arrays, base 2; NULL if one of them is empty."""
    total_a, total_b, distance = _js_parts(a, b)
    df = df.withColumn("_total_a", total_a).withColumn("_total_b", total_b)
    return df.withColumn(name, distance).drop("_total_a", "_total_b")


def judge_quality(
    docs: DataFrame,
    min_words: int = 50,
    repeat_percent: int = 50,
    common: int = 20,
    max_class_distance: float = 0.3,
    max_word_distance: float = 0.36,
    min_chars: int = 250,
    min_histogram_words: int = 100,
) -> DataFrame:
    """doc_id, the base measures, both distances, base_failed and kept: one row per document.

    Texts are read twice: to count common words, and to measure each document. The measures are
    written down; references are sums over them.
    """
    rows = docs.select("doc_id", "lang", "text")
    same = F.col("lang").eqNullSafe(F.col("_lang"))
    known = broadcast_if_small(staged(common_words(rows, common), "common-words"))
    texts = rows.join(known, same, "left").select("doc_id", "lang", "common", text_of().alias("_t"))
    texts = texts.withColumn("_words", let(F.col("_t"), words_of))
    texts = texts.withColumn("_windows", F.sort_array(packed_windows(F.col("_words"))))
    inputs = [F.col(c) for c in ("_t", "_words", "_windows", "common")]
    measured = staged(
        texts.select("doc_id", "lang", measures(*inputs, common).alias("_m")).select(
            "doc_id", "lang", "_m.*"
        ),
        "measures",
    )
    references = measured.groupBy(F.col("lang").alias("_lang")).agg(
        summed("classes", len(CLASSES) + 2).alias("_class_ref"),
        summed("histogram", common + 1).alias("_word_ref"),
    )
    judged = measured.join(broadcast_if_small(staged(references, "references")), same)
    judged = with_distance(judged, "classes", "_class_ref", "class_distance")
    judged = with_distance(judged, "histogram", "_word_ref", "word_distance")
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent
    )

    def far(distance: str, limit: float, long_enough: Column) -> Column:
        return long_enough & F.coalesce(F.col(distance) > limit, F.lit(False))

    odd = far("class_distance", max_class_distance, F.col("chars") >= min_chars) | far(
        "word_distance", max_word_distance, F.col("n_words") >= min_histogram_words
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "class_distance",
        "word_distance",
        failed.alias("base_failed"),
        (~failed & ~odd).alias("kept"),
    )
