"""Line-oriented text inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions import right_strip


def read_id_list(spark: SparkSession, path: str, n: int = -1) -> DataFrame:
    """One id per line, right-stripped; all of them for n < 0, else the first n.

    Lines are ordered by (file, split, position in split), so the first n are taken from
    a list of any size without gathering it in one task.
    """
    if n < 0:
        return spark.read.text(path).select(right_strip(F.col("value")).alias("experiment"))
    lines = spark.read.text(path).select(
        right_strip(F.col("value")).alias("experiment"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return lines.orderBy("_file", "_start", "_line").limit(n).select("experiment")
