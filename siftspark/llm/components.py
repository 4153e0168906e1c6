"""Connected components of an edge list, by rounds of joins; each round is written down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import staged
from siftspark.operators.scope import broadcast_if_small

#: Bytes of rows of numbers that are broadcast, by their measured size, rather than shuffled.
NEAR_BYTES = 16 << 20


def _least(edges: DataFrame) -> DataFrame:
    """doc_id, component (its smallest end), loose (whether its edges are more than one star's) per node."""
    roots = edges.select(F.col("b").alias("a"), "b")
    least = edges.unionByName(roots).groupBy(F.col("a").alias("doc_id")).agg(
        F.min("b").alias("component"), F.max("b").alias("_most")
    )
    return least.select("doc_id", "component", (F.col("component") < F.col("_most")).alias("loose"))


def _round(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Large-star, then small-star: edges (a, b), a > b, of the same components."""
    near = broadcast_if_small(least.select("doc_id", "component"), NEAR_BYTES)
    # A node hangs its larger neighbours onto the smallest it sees: seen from them, b becomes b's least.
    large = edges.join(near, F.col("b") == F.col("doc_id")).select("a", F.col("component").alias("b"))
    ends = large.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_least"))
    small = large.join(ends, F.col("a") == F.col("_a"))
    hung = small.select("b", "_least").filter("b <> _least").toDF("a", "b")
    return hung.unionByName(small.select("a", F.col("_least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """doc_id, component (the smallest id reachable) for every end of an edge (a, b).

    Large-star, small-star: each node hangs its neighbours onto the smallest id it sees, until
    every component is one star, which one aggregate tells. A hot node costs rows of two numbers,
    added up map-side.
    """
    stars = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        least = staged(_least(stars), "least-ends")
        if least.filter("loose").isEmpty():
            return least.select("doc_id", "component")
        stars = staged(_round(stars, least), "stars")
