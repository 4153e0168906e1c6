"""The key side of semi and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(keys: DataFrame) -> DataFrame:
    """Distinct rows of a key list, as a join side that leaves AQE free to split hot keys.

    AQE splits a hot key of the other side only where both join inputs come straight from
    a shuffle. After a plain `distinct` the join would take over the aggregate's
    partitioning instead of shuffling. Grouping by a value derived from the key as well
    gives the same rows in a partitioning the join does not take over. The price, one more
    shuffle of distinct keys, is only paid where the keys are too many to be broadcast.
    """
    derived = F.pmod(F.xxhash64(*keys.columns), F.lit(1))
    return keys.withColumn("_derived", derived).distinct().select(*keys.columns)
