"""Hot keys without broadcasts: the work is split and the rows are whole."""

import pytest
from pyspark.sql import functions as F

from siftspark.operators import in_scope, merge_upsert
from siftspark.sinks import read_table, write_table

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def hot(shuffled, tmp_path):
    """Half of 200,000 rows belong to one experiment, a third of all have no id."""
    rows = shuffled.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("E"), F.col("id"))).alias("experiment"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    rows.write.parquet(str(tmp_path / "hot"))
    return shuffled.read.parquet(str(tmp_path / "hot"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    # The noop write plans anew; run the frame itself to see the plan AQE settles on.
    df._jdf.queryExecution().executedPlan().execute().count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scope_join_splits_the_hot_experiment(shuffled, hot):
    scope = hot.filter("experiment <> 'E1'").select(F.lit("c").alias("category"), "experiment")
    kept = in_scope(hot, scope, "c")
    plan = final_plan(kept)
    assert "SortMergeJoin(skew=true)" in plan and "LeftSemi" in plan
    assert kept.count() == 199_999


def test_merge_splits_the_key_without_id(shuffled, hot):
    source = hot.filter("experiment = 'HOT' AND id IS NULL").select("experiment", "id", F.lit("new").alias("text"))
    target = hot.unionByName(hot.filter("experiment = 'HOT' AND id IS NOT NULL").withColumn("id", F.concat("id", F.lit("b"))))
    merged = merge_upsert(target, source, ["experiment", "id"], null_safe=True)
    plan = final_plan(merged)
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan
    assert merged.count() == target.count()
    assert merged.filter("text = 'new'").count() == source.count() > 30_000


def test_hot_bucket_is_written_by_many_tasks(shuffled, hot, tmp_path):
    path = str(tmp_path / "table")
    write_table(hot, path, 4)
    stored = read_table(shuffled, path, hot.schema, 4)
    files = stored.filter("experiment = 'HOT'").select(F.input_file_name()).distinct().count()
    assert files > 3
    assert read_table(shuffled, path, hot.schema, 4).count() == 200_000
