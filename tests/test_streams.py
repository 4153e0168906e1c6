"""Streams of drifting JSON: whatever the kept schema can't hold is rescued."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.functions import not_held
from siftspark.sinks import write_category_documents
from siftspark.streaming import stream_inferred
from siftspark.streaming.files import _latest

DDL = (
    "id long, price double, exact decimal(10,2), ok boolean, name string, o struct<x: long, p: struct<y: string>>, "
    "list array<long>, rows array<struct<a: long, b: array<double>>>"
)
HELD = [
    {},
    {"id": 1, "price": 2, "exact": 1.25, "ok": True, "name": "n"},
    {"id": None, "o": None, "list": None, "rows": [None]},
    {"o": {"x": 1, "p": {"y": "z"}}, "list": [1, None, 3], "rows": [{"a": 1, "b": [1, 2.5]}, {}]},
    {"price": 0.1, "list": [], "rows": []},
    {"name": {"any": ["text"]}},
]
LOST = [
    {"new": 1},
    {"new": {"deep": []}},
    {"id": "abc"},
    {"id": 1.5},
    {"id": 2**63},
    {"price": 2**53 + 1},
    {"exact": 1.255},
    {"ok": "yes"},
    {"o": {"x": 1, "new": "LOST"}},
    {"o": {"p": {"y": "z", "q": None}}},
    {"o": {"p": "text"}},
    {"o": [1]},
    {"list": 3},
    {"list": [1, "x"]},
    {"rows": [{"a": 1}, {"a": 1, "c": 2}]},
    {"rows": [{"b": [1, "x"]}]},
]


@pytest.mark.parametrize("expected, cases", [(False, HELD), (True, LOST)])
def test_every_loss_is_seen(spark, expected, cases):
    lines = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "i int, value string")
    schema = T.StructType.fromDDL(DDL)
    rows = lines.withColumn("_row", F.from_json("value", schema))
    found = rows.select("i", not_held(F.try_parse_json("value"), F.col("_row"), schema).alias("lost")).collect()
    assert {r["i"] for r in found if r["lost"] is not expected} == set()


def test_nothing_is_null_in_both_places(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    first = ['{"id": 1, "o": {"x": 1}}', '{"id": 2, "o": {"x": null}}']
    later = [
        '{"o": {"newfield": "LOST"}}', '{"id": "abc"}', '{"id": 3, "o": {"x": 4}}', "[1]", "{broken", "",
        '{"id": 1, "id": 2}', '{"id": null}', '{"Id": 5}',
    ]
    for name, lines in (("1", first), ("2", later)):
        (landing / f"{name}.json").write_text("".join(x + "\n" for x in lines))
        stream = stream_inferred(spark, str(landing), str(tmp_path / "kept"))
        sink = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "seen"))
        sink.trigger(availableNow=True).start(out).awaitTermination()
    rescued = [r["_rescued"] for r in spark.read.parquet(out).filter("_rescued IS NOT NULL").collect()]
    held = spark.read.parquet(out).filter("_rescued IS NULL").select("id", "o.x").collect()
    kept = ['{"id": 3, "o": {"x": 4}}', '{"id": null}']
    assert sorted(rescued) == sorted(x for x in later if x not in kept)
    assert sorted(held, key=repr) == sorted([(1, 1), (2, None), (3, 4), (None, None)], key=repr)


@pytest.mark.parametrize("again, shuffled", [([], False), ([3, 7], True), (range(20), True)])
def test_only_experiments_that_come_again_are_shuffled(spark, again, shuffled):
    columns = "experiment string, etag string, data string, landed_at int, file string, part_of_file long, place long"
    rows = [(f"E{i}", "first", f"d{i}", 1, "b", 9, 9) for i in range(20)]
    rows += [(f"E{i}", "last", f"d{i}", 1, "b", 9, 10) for i in again]
    rows += [(f"E{i}", "other file", f"d{i}", 1, "a", 99, 99) for i in again]
    latest = _latest(spark.createDataFrame(rows, columns))
    found = {r["experiment"]: (r["etag"], r["data"]) for r in latest.collect()}
    assert latest.count() == 20
    assert found == {f"E{i}": ("last" if i in again else "first", f"d{i}") for i in range(20)}
    assert ("SortAggregate" in plan_of(latest)) is shuffled


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_category_documents_without_a_shuffle(spark, tmp_path):
    rows = [(f"E{i}", c, {"a": [str(i)] * 3}) for i in range(50) for c in ("entity", "exptl")]
    documents = spark.createDataFrame(rows, "experiment string, category string, attributes map<string,array<string>>")
    write_category_documents(documents.coalesce(2), str(tmp_path / "tasks"), even=False)
    write_category_documents(documents.coalesce(2), str(tmp_path / "even"))
    read = [sorted(map(str, spark.read.parquet(str(tmp_path / x)).collect())) for x in ("tasks", "even")]
    assert read[0] == read[1] and len(read[0]) == 100
    # Each of the two tasks wrote what it had of a category.
    assert len(list((tmp_path / "tasks" / "category=entity").glob("*.parquet"))) == 2
