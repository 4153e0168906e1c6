"""Column expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the token that stands for a missing value. '.' is not one.
MISSING = ("?",)

# The ASCII characters that end-of-line trimming removes.
_LINE_SPACE = " \t\r\n\f\x0b"


def null_if_token(c: Column, tokens: tuple[str, ...] = MISSING) -> Column:
    """NULL where the whole cell is one of the tokens."""
    return F.when(~c.isin(*tokens), c)


def strip_prefix(c: Column, prefix: str = "_") -> Column:
    """Drop one leading prefix."""
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def right_strip(c: Column) -> Column:
    return F.rtrim(c, F.lit(_LINE_SPACE))


def experiment_of_file(path: Column) -> Column:
    """The 4-character code before the extension of `.../CODE.json`."""
    return F.left(F.right(path, F.lit(9)), F.lit(4))


def experiment_of_code_file(name: Column) -> Column:
    """The code of a file name that is nothing but `CODE.json`, NULL for any other name."""
    return F.when(name.rlike(r"^[0-9A-Za-z]{4}\.json$"), experiment_of_file(name))


def after_dot(c: Column) -> Column:
    """The attribute of an item name `_category.attribute`."""
    return F.split_part(c, F.lit("."), F.lit(2))


def bucket(c: Column, n: int) -> Column:
    """Storage bucket of a key; stable across runs and engines' restarts."""
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
