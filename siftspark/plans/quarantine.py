"""Documents that a run could not take, kept with the reason until they are taken.

Each step of a run, or of a stream's batch, overwrites only its own rows, so a step may be repeated
and no run deletes what another set aside. Experiments set aside are not recorded as held, so
the next run takes them up again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.plans.layout import Layout
from siftspark.registry import LINEAGE

SET_ASIDE = "experiment string, category string, reason string, document string"


def set_aside(
    rows: DataFrame, layout: Layout, run: str, step: str, reason: Column, document: Column,
    category: str | None = None,
) -> None:
    """Keep the rows' experiments with the reason and what there is of their documents."""
    rows.select(
        LINEAGE,
        F.lit(category).cast("string").alias("category"),
        reason.alias("reason"),
        document.alias("document"),
    ).write.mode("overwrite").parquet(layout.quarantine(run, step))


def read_quarantine(spark: SparkSession, layout: Layout, run: str | None = None) -> DataFrame:
    """Rows (experiment, category, reason, document, run, step), of one run or of all."""
    schema = f"{SET_ASIDE}, run string, step string"
    try:
        held = spark.read.schema(schema).parquet(layout.quarantine())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return held if run is None else held.filter(F.col("run") == run)
