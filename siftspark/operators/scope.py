"""Which experiments a run touches.

No join here is hinted unseen: Catalyst broadcasts the key side when its size statistics are under
`spark.sql.autoBroadcastJoinThreshold` (AQE re-checks with the measured size), and beyond
that joins by shuffle, where AQE splits a hot experiment on the data side over many tasks.
The key side is made distinct first, which combines copies before they are shuffled; see
`distinct_keys` for how that leaves the split possible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.keys import distinct_keys


MAX_BROADCAST_BYTES = 128 << 20


def broadcast_if_small(keys: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the measured size of the keys is under the limit.

    For a written key list beside rows too heavy to shuffle, such as whole texts. A row is
    counted with 64 bytes on top of its text, which is more than a hashed row takes.
    """
    def text(field):
        arrays = field.dataType.typeName() in ("array", "map", "struct")
        return F.to_json(F.struct(field.name)) if arrays else F.col(field.name).cast("string")

    texts = [F.coalesce(F.octet_length(text(f)), F.lit(0)) for f in keys.schema.fields]
    size = keys.agg(F.sum(sum(texts, F.lit(64))).alias("bytes")).first()["bytes"]
    return F.broadcast(keys) if size is None or size <= limit else keys


def in_scope(
    df: DataFrame, scope: DataFrame, category: str | None = None, key: str = "experiment"
) -> DataFrame:
    """Rows whose experiment the run lists, for one category or for any."""
    if category is not None:
        scope = scope.filter(F.col("category") == category)
    return df.join(distinct_keys(scope.select(key)), key, "left_semi")


def build_scope(documents: DataFrame) -> DataFrame:
    """(category, experiment) pairs that hold data."""
    return documents.select("category", "experiment").distinct()


def changed(
    manifest: DataFrame, present: DataFrame, key: str = "experiment", version: str = "etag"
) -> DataFrame:
    """Manifest rows that are missing from `present` or held in another version."""
    return manifest.join(distinct_keys(present.select(key, version)), [key, version], "left_anti")


def latest_versions(
    present: DataFrame, key: str = "experiment", version: str = "etag", order: str | None = None
) -> DataFrame:
    """One version per key: the last by `order`, or the greatest if there is no order."""
    last = F.max(version) if order is None else F.max_by(version, order)
    return present.groupBy(key).agg(last.alias(version))


def version_status(
    manifest: DataFrame, present: DataFrame, key: str = "experiment", version: str = "etag"
) -> DataFrame:
    """Manifest rows with status new, changed or unchanged. `present` has one row per key."""
    held = present.select(key, F.col(version).alias("_held"), F.lit(True).alias("_known"))
    status = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_held") == F.col(version), "unchanged")
        .otherwise("changed")
    )
    return manifest.join(held, key, "left").select(*manifest.columns, status.alias("status"))
