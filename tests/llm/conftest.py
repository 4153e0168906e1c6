"""Small tables with the cases every operator must bear."""

import pytest

#: Columns that clash with names the operators use themselves.
EXTRA = ("size", "target", "score", "epoch", "words", "row", "key", "spans", "component", "weight")
LONG = "lorem ipsum dolor sit amet " * 8000
BASE = (
    "the quick brown fox jumps over the lazy dog while nine small birds sing near the old stone "
    "bridge and the river runs slowly under grey clouds toward a distant harbour town where people wait"
)


def rows():
    near = BASE.replace("grey", "dark")
    return [
        (1, BASE, "en", "a", len(BASE)),
        (2, near, "en", "b", len(near)),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n", "en", "b", 3),
        (6, BASE, "en", "a", len(BASE)),
        (6, BASE, "en", "a", len(BASE)),
        (7, LONG, "de", "b", len(LONG)),
        (8, "one two", "en", None, 7),
        (9, 'token = "abcdef0123456789abcdef0123456789" \\ end', "en", "a", 50),
        (None, "no id here", "en", "a", 10),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(
        [(*r, *(["x"] * len(EXTRA))) for r in rows()], f"{schema}, {extra}"
    )


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, 1 if i != 7 else 0, 1 if i == 8 else 0) for i in range(1, 10)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="session")
def benchmark(spark):
    items = [(1, " ".join(BASE.split()[3:20]).upper()), (2, None), (3, "one two"), (4, "")]
    return spark.createDataFrame(items, "item_id long, text string")
