"""Row numbers without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftspark.session import work_path


def row_numbers(
    df: DataFrame, order: list[str], keys: list[str] | None = None, name: str = "rn"
) -> DataFrame:
    """1, 2, ... by `order`, over all rows or within `keys`, for groups of any size.

    A plain window puts a whole group (without keys: all rows) into one task. Here rows are
    range-partitioned and sorted on (keys, order), numbered as they stand in their range,
    and staged; a hot key spreads over as many ranges as it fills. What is left is to shift
    the numbers by the key's rows in earlier ranges: one count per key and range, joined
    back. `order` should be unique within a key, as for any row number.
    """
    spark, keys = df.sparkSession, keys or []
    staged_at = work_path(spark, "ranges")
    # A monotonically increasing id is (partition << 33) + place in the partition.
    place = F.monotonically_increasing_id()
    (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_place", place)
        .withColumn("_range", F.shiftright("_place", 33))
        .write.parquet(staged_at)
    )
    staged = spark.read.parquet(staged_at)

    ranges = staged.groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    # Ordered by range, a key has one row per range here: no more than there were tasks.
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Keys may be NULL: compare them null-safely, on names that do not clash.
    shifts = ranges.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_r"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return staged.join(shifts, same).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias(name)
    )
