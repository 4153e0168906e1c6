"""Documents that keep a category as a struct of arrays, one document per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.reshape import conform, explode_indexed
from siftspark.registry import LINEAGE, Category


def explode_category(
    raw: DataFrame, category: Category, column: str | None = None, key: str = "experiment_id"
) -> DataFrame:
    """`raw` rows (key, struct of arrays) to bronze rows of the category."""
    column = column or f"_{category.name}"
    present = [f.name for f in raw.schema[column].dataType.fields]
    arrays = raw.select(
        F.col(key).alias(LINEAGE),
        *[F.col(column).getField(a).alias(a) for a in category.attributes if a in present],
    )
    rows = explode_indexed(arrays, [a for a in arrays.columns if a != LINEAGE], [LINEAGE])
    return conform(rows, category.names)
