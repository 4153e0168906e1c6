import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.plans import Layout, build_registry, read_quarantine, write_registry
from siftspark.registry import REQUIREMENTS, Registry, default_registry, registry_from_frame
from siftspark.sinks import (
    append_by_name,
    append_positional,
    append_rows,
    create_json_table,
    create_table,
    drop_table,
    read_table,
    truncate,
    truncate_reload,
    write_raw,
)
from siftspark.sources import (
    category_documents,
    dictionary_links,
    json_path,
    pending_inputs,
    raw_eav,
    raw_versions,
    read_id_list,
    read_raw_json,
)
from siftspark.streaming import stream_raw, stream_to_bronze

REG = default_registry()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_id_list(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("1EMA  \n100D\t\r\n4HHB\n")
    path = str(tmp_path / "ids.txt")
    assert rows(read_id_list(spark, path)) == [("100D",), ("1EMA",), ("4HHB",)]
    assert [r[0] for r in read_id_list(spark, path, 2).collect()] == ["1EMA", "100D"]
    assert read_id_list(spark, path, 0).collect() == []


def test_ledger(spark):
    ledger = spark.createDataFrame([("A", None), ("B", 1)], "experiment string, n int").select(
        "experiment", F.current_timestamp().alias("added_ts"), F.timestamp_seconds("n").alias("finished_ts")
    )
    assert [r["experiment"] for r in pending_inputs(ledger).collect()] == ["A"]


def test_raw_json_by_file_name_and_by_column(spark, tmp_path):
    doc = {"data": {"_entity": {"id": ["1"], "details": "[x"}, "exptl": {"method": "EPR", "bogus": "1"},
                    "_cell": {"length_a": "1"}}, "etag": "\"e-1\""}
    (tmp_path / "100d.json").write_text(json.dumps(doc))
    path = str(tmp_path)
    assert rows(raw_versions(spark, path)) == [("100D", '"e-1"')]
    for names in (None, REG.names):
        found = category_documents(read_raw_json(spark, path, names), REG)
        assert rows(found) == [
            ("100D", "entity", {"id": ["1"], "details": ["[x"]}),
            ("100D", "exptl", {"method": ["EPR"]}),
        ]
    assert ("100D", "cell", "length_a", ["1"]) in rows(raw_eav(read_raw_json(spark, path)))
    assert json_path(spark, path).first()["etag"] == '"e-1"'
    only_unknown = read_raw_json(spark, path).select("experiment", F.map_filter("data", lambda k, _: k == "_cell").alias("data"))
    assert category_documents(only_unknown, REG).isEmpty()


def test_raw_sink_takes_trees_and_json_text(spark, tmp_path):
    text = '{"_entity": {"id": ["1", "2}"], "type": "w\\"x"}}'
    raw = spark.createDataFrame([("A", 'W/"}', text), ("B", None, "{}")], "experiment string, etag string, data string")
    write_raw(raw, str(tmp_path / "text"))
    tree = raw.withColumn("data", F.from_json("data", "map<string,map<string,variant>>"))
    write_raw(tree, str(tmp_path / "tree"), compression="gzip")
    for name in ("text", "tree"):
        path = str(tmp_path / name)
        assert rows(raw_versions(spark, path)) == [("A", 'W/"}'), ("B", None)]
        assert rows(raw_eav(read_raw_json(spark, path))) == [
            ("A", "entity", "id", ["1", "2}"]), ("A", "entity", "type", ['w"x'])
        ]


PAGE = """<html><ul class="list-group other"><li class="list-group-item">
<a class="mytip" href="#x">_entity.tip</a><a href="/i/1">_entity.id</a></li>
<li><a href="/no">_entity.not_an_item</a></li>
<li class="list-group-item"><a href="/i/2">_entity.<b>type</b></a><a href="/i/3">_entity.a&amp;b</a></li></ul>
<ul><li class="list-group-item"><a href="/no">_entity.outside</a></li></ul></html>"""


def test_dictionary_and_registry(spark, tmp_path):
    pages = spark.createDataFrame([("entity", PAGE), ("cell", PAGE)], "category string, html string")
    links = dictionary_links(pages).filter("category = 'entity'")
    assert rows(links.select("ordinal", "attribute", "link")) == [
        (0, "id", "/i/1"), (1, "type", "/i/2"), (2, "a&b", "/i/3")
    ]
    requirements = spark.createDataFrame(REQUIREMENTS + [("entity", "extra")], "category string, attribute string")
    attributes = build_registry(pages, requirements, "https://host")
    assert rows(attributes.select("category", "ordinal", "attribute")) == [
        ("entity", 1, "id"), ("entity", 2, "type"), ("entity", 3, "a&b"), ("entity", 4, "extra"),
        ("exptl", 1, "entry_id"), ("exptl", 2, "method"),
    ]
    found = {(r["category"], r["attribute"]): r["link"] for r in attributes.collect()}
    assert found["entity", "id"] == "https://host/i/1"
    assert found["exptl", "method"].endswith("/Items/_exptl.method.html")
    registry = registry_from_frame(attributes)
    assert registry["entity"].names == ["experiment", "id", "type", "a&b", "extra"]
    assert registry["entity"].keys == ["experiment", "id"]
    assert registry["exptl"].required == ["experiment", "entry_id", "method"]
    write_registry(attributes, registry, str(tmp_path))
    carcass = {r["category"]: r["attributes"] for r in spark.read.json(f"{tmp_path}/schema_carcass").collect()}
    assert carcass == {"entity": ["id", "type", "a&b", "extra"], "exptl": ["entry_id", "method"]}


def test_tables(spark, tmp_path):
    name, path = "siftspark_test_exptl", str(tmp_path / "t")
    spec = REG["exptl"]
    create_table(spark, name, spec.silver_schema(), path, replace=True)
    create_table(spark, name, spec.silver_schema(), path, if_not_exists=True)
    append_rows(spark, [("A", "A", "EPR")], name)
    append_positional(spark.createDataFrame([("B", "B", "EPR")], "x string, y string, z string"), name)
    append_by_name(spark.createDataFrame([("SOLUTION NMR", "C", "C")], "method string, entry_id string, experiment string"), name)
    assert rows(spark.table(name)) == [("A", "A", "EPR"), ("B", "B", "EPR"), ("C", "C", "SOLUTION NMR")]
    truncate_reload(spark.createDataFrame([("D", "D", "EPR")], spec.bronze_schema()), name)
    assert rows(spark.table(name)) == [("D", "D", "EPR")]
    truncate(spark, name)
    assert rows(spark.table(name)) == []
    drop_table(spark, name)
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "1.json").write_text('{"a": "1"}')
    assert rows(create_json_table(spark, name, str(tmp_path / "j"))) == [("1",)]
    drop_table(spark, name)


def test_stream_takes_the_last_document_and_new_files_only(spark, tmp_path):
    landing, layout = tmp_path / "raw", Layout(str(tmp_path / "archive"), buckets=2)
    landing.mkdir()
    few = Registry({"exptl": REG["exptl"]})

    def put(file, experiment, method, at):
        import os

        doc = {"experiment": experiment, "data": {"_exptl": {"entry_id": "x", "method": method}}, "etag": "e"}
        (landing / file).write_text(json.dumps(doc))
        os.utime(landing / file, (at, at))

    def run():
        checkpoint = str(tmp_path / "seen")
        stream_to_bronze(stream_raw(spark, str(landing)), layout, few, checkpoint).awaitTermination()
        return rows(read_table(spark, layout.bronze("exptl"), few["exptl"].bronze_schema(), 2))

    put("a.json", "A", "EPR", 1_000_000)
    put("b.json", "a", "SOLUTION NMR", 1_000_050)
    put("c.json", "B", "EPR", 1_000_000)
    assert run() == [("A", "x", "SOLUTION NMR"), ("B", "x", "EPR")]
    put("d.json", "B", "FIBER DIFFRACTION", 1_000_100)
    put("nest.json", "B", {"not": "a value"}, 1_000_200)
    put("long-name.json", None, "EPR", 1_000_200)
    (landing / "e.json").write_text('{"experiment": "C", "da')
    assert run() == [("A", "x", "SOLUTION NMR"), ("B", "x", "FIBER DIFFRACTION")]
    aside = read_quarantine(spark, layout).select("reason", "step")
    assert rows(aside) == [("corrupt", "files"), ("nested", "files"), ("no experiment", "files")]
    assert run() == [("A", "x", "SOLUTION NMR"), ("B", "x", "FIBER DIFFRACTION")]
