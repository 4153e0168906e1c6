"""Small control inputs: the work ledger and rows given in the program."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators.keys import distinct_keys

LEDGER = "experiment string, added_ts timestamp, finished_ts timestamp"


def pending_inputs(ledger: DataFrame) -> DataFrame:
    """Ledger entries nobody has finished."""
    return ledger.filter(F.col("finished_ts").isNull())


def finish_inputs(ledger: DataFrame, done: DataFrame, at: Column) -> DataFrame:
    """The ledger with `finished_ts` set on open entries of the experiments in `done`, in any case of letters."""
    keys = distinct_keys(done.select(F.upper("experiment").alias("_done")))
    found = ledger.join(keys, F.upper("experiment") == F.col("_done"), "left")
    stamp = F.coalesce("finished_ts", F.when(F.col("_done").isNotNull(), at))
    return found.withColumn("finished_ts", stamp).drop("_done")


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
