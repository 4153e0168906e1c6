"""Key-based upsert and replacement, as plain DataFrame plans.

`update set *` / `insert *` on a key means that the source's row stands for that key
afterwards, so an upsert is the target without the source's keys, plus the source. That is
one anti join whose right side is the distinct key list; source rows are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.keys import distinct_keys


def _without_keys(target: DataFrame, keys_of: DataFrame, keys: list[str], null_safe: bool):
    taken = distinct_keys(keys_of.select(*[F.col(k).alias(f"_s_{k}") for k in keys]))

    def same(k: str):
        left, right = F.col(k), F.col(f"_s_{k}")
        return left.eqNullSafe(right) if null_safe else left == right

    return target.join(taken, reduce(lambda a, b: a & b, map(same, keys)), "left_anti")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False
) -> DataFrame:
    """Target after the source is merged into it on the keys.

    With `null_safe`, NULL equals NULL in a key, so rows with an incomplete key are
    replaced by a rerun; without it they match nothing and are inserted again.
    """
    return _without_keys(target, source, keys, null_safe).unionByName(source)


def replace_by_key(
    target: DataFrame, source: DataFrame, key: str, listed: DataFrame | None = None
) -> DataFrame:
    """Target without the listed keys (by default the source's), plus the source."""
    kept = _without_keys(target, source if listed is None else listed, [key], False)
    return kept.unionByName(source)
