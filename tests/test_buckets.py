"""Stored tables: writers that die or meet, readers in between, scans of the touched buckets only."""

import pytest
from pyspark.sql import functions as F

from siftspark.registry import Registry, category, default_registry, registry_from_frame
from siftspark.sinks import merge_into, read_table
from siftspark.sinks import buckets as sink
from siftspark.sources import category_documents

SPEC = default_registry()["exptl"]


def frame(spark, names, method):
    return spark.createDataFrame([(n, n, method) for n in names], SPEC.bronze_schema())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def filled(spark, tmp_path, n=4):
    path, names = str(tmp_path / "t"), [f"{i:04d}" for i in range(40)]
    sink.write_table(frame(spark, names, "EPR"), path, n)
    return path, names, [(x, x, "EPR") for x in names]


def merge(spark, path, names, method, n=4):
    schema = SPEC.bronze_schema()
    merge_into(spark, path, schema, frame(spark, names, method), ["experiment", "entry_id"], n=n)


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path, names, before = filled(spark, tmp_path)
    schema = SPEC.bronze_schema()

    def die(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(sink, "publish", die)  # the rows are written, and the driver dies
        with pytest.raises(RuntimeError):
            merge(spark, path, names[:1], "SOLUTION NMR")
    assert rows(read_table(spark, path, schema, 4)) == before
    assert len(list((tmp_path / "t").glob("rows-*"))) == 2
    merge(spark, path, names[:1], "SOLUTION NMR")
    expected = [(names[0], names[0], "SOLUTION NMR"), *before[1:]]
    sink.vacuum(spark, path, 4)
    assert rows(read_table(spark, path, schema, 4)) == expected
    assert len(list((tmp_path / "t").glob("rows-*"))) == 2  # of two versions; the dead writer's is gone


def test_a_reader_in_the_middle_of_a_change(spark, tmp_path, monkeypatch):
    path, names, before = filled(spark, tmp_path)
    schema, publish, seen = SPEC.bronze_schema(), sink.publish, []
    early = read_table(spark, path, schema, 4)

    def read_first(*given):
        files = sorted(str(x) for x in (tmp_path / "t").rglob("*"))
        seen.append(rows(read_table(spark, path, schema, 4)))
        assert files == sorted(str(x) for x in (tmp_path / "t").rglob("*"))  # readers write nothing
        return publish(*given)

    monkeypatch.setattr(sink, "publish", read_first)
    merge(spark, path, names, "SOLUTION NMR")
    assert seen == [before]
    # Opened before the change, read after it: still one version from end to end.
    assert rows(early) == before
    assert rows(read_table(spark, path, schema, 4)) == [(x, x, "SOLUTION NMR") for x in names]


def test_of_two_writers_the_second_must_read_again(spark, tmp_path, monkeypatch):
    path, names, before = filled(spark, tmp_path)
    schema, publish = SPEC.bronze_schema(), sink.publish

    def after_another(*given):
        monkeypatch.setattr(sink, "publish", publish)
        merge(spark, path, names[1:2], "SOLUTION NMR")
        return publish(*given)

    monkeypatch.setattr(sink, "publish", after_another)
    with pytest.raises(sink.TableChanged):
        merge(spark, path, names[:1], "SOLUTION NMR")
    expected = [before[0], (names[1], names[1], "SOLUTION NMR"), *before[2:]]
    assert rows(read_table(spark, path, schema, 4)) == expected
    merge(spark, path, names[:1], "SOLUTION NMR")
    assert rows(read_table(spark, path, schema, 4))[0] == (names[0], names[0], "SOLUTION NMR")


def test_each_change_writes_its_buckets_once(spark, tmp_path):
    path, names, _ = filled(spark, tmp_path, 16)
    for turn in range(4):
        merge(spark, path, names[:1], f"T{turn}", 16)
        newest = max((tmp_path / "t").glob("rows-*"), key=lambda x: x.stat().st_mtime_ns)
        assert [x.name.split("=")[0] for x in newest.glob("*=*")] == ["bucket_16"]
    assert len(list((tmp_path / "t" / "_versions").glob("0*"))) == 2
    # The first load holds 15 buckets still; of the others, those of the last two versions are there.
    assert len(list((tmp_path / "t").glob("rows-*"))) == 3
    assert rows(read_table(spark, path, SPEC.bronze_schema(), 16))[0][2] == "T3"


def test_a_small_scope_scans_its_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "t"), SPEC.bronze_schema()
    sink.write_table(frame(spark, [f"{i:04d}" for i in range(64)], "EPR"), path, 16)
    scope = spark.createDataFrame([("0001",)], "experiment string")
    found = read_table(spark, path, schema, 16, of=scope)
    assert len({x.split("bucket_16=")[1].split("/")[0] for x in found.inputFiles()}) == 1
    assert len({x.split("bucket_16=")[1].split("/")[0] for x in read_table(spark, path, schema, 16).inputFiles()}) == 16
    assert ("0001", "0001", "EPR") in rows(found)


def test_a_registry_of_any_size(spark):
    many = spark.range(25_000).select(
        F.lit("wide").alias("category"), F.concat(F.lit("a"), "id").alias("attribute"), F.col("id").alias("ordinal")
    )
    registry = registry_from_frame(many)
    assert len(registry["wide"].attributes) == 25_000
    raw = spark.createDataFrame(
        [("1AAA", {"_wide": {"a24999": "x", "b": "y"}, "other": {"a1": "z"}})],
        "experiment string, data map<string,map<string,string>>",
    ).withColumn("data", F.from_json(F.to_json("data"), "map<string,map<string,variant>>"))
    found = category_documents(raw, registry).collect()
    assert [(r["experiment"], r["category"], r["attributes"]) for r in found] == [
        ("1AAA", "wide", {"a24999": ["x"]})
    ]


def test_categories_may_share_names_of_attributes():
    registry = Registry({c: category(c, ["experiment", "id"], keys=["experiment"]) for c in "ab"})
    assert registry.names == ["a", "b"]


def test_merges_refuse_what_breaks_the_contract(spark, tmp_path):
    path, names, before = filled(spark, tmp_path)
    schema = SPEC.silver_schema()
    keys = ["experiment", "entry_id"]
    twice = frame(spark, [names[0], names[0]], "SOLUTION NMR")
    with pytest.raises(ValueError, match="several source rows"):
        merge_into(spark, path, SPEC.bronze_schema(), twice, keys, n=4)
    required = [f.name for f in schema.fields if not f.nullable]
    hole = frame(spark, names[:1], "SOLUTION NMR").withColumn(required[-1], F.lit(None).cast("string"))
    with pytest.raises(ValueError, match=f"{required[-1]} \\(1 rows\\)"):
        merge_into(spark, path, schema, hole, keys, n=4)
    assert rows(read_table(spark, path, SPEC.bronze_schema(), 4)) == before


def test_null_safe_merges_take_incomplete_keys(spark, tmp_path):
    path, names, before = filled(spark, tmp_path)
    twice = spark.createDataFrame([(names[0], None, "a"), (names[0], None, "b")], SPEC.bronze_schema())
    for _ in range(2):
        merge_into(spark, path, SPEC.bronze_schema(), twice, ["experiment", "entry_id"], null_safe=True, n=4)
    assert len(rows(read_table(spark, path, SPEC.bronze_schema(), 4))) == len(before) + 2


@pytest.mark.parametrize("kept", [[], ["0007"], [None]])
def test_rows_are_only_looked_through_where_some_are_kept(spark, tmp_path, monkeypatch, kept):
    path, schema = str(tmp_path / "t"), SPEC.bronze_schema()
    names, seen = [f"{i:04d}" for i in range(40) if f"{i:04d}" not in kept], []
    sink.write_table(frame(spark, names, "EPR").unionByName(frame(spark, kept, "EPR")), path, 1)
    replace = sink.replace_by_key

    def watch(target, *rest):
        seen.append(target.count())
        return replace(target, *rest)

    monkeypatch.setattr(sink, "replace_by_key", watch)
    source = frame(spark, names, "SOLUTION NMR")
    sink.replace_experiments(spark, path, schema, source, listed=source.select("experiment"), n=1)
    expected = [(x, x, "SOLUTION NMR") for x in names] + [(x, x, "EPR") for x in kept]
    assert rows(read_table(spark, path, schema, 1)) == sorted(expected, key=repr)
    assert seen == [len(names) + len(kept) if kept else 0]
